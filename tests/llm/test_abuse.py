import re
import sys

import numpy as np
import pytest

from cairnflow.llm import abuse

CLEAN = [
    "The board appointed a treasurer and the lease was amended.", "Bonds may be stripped and sold as separate instruments.", "Idiot-proof packaging cut returns.", "The bitch, a trained guard dog, is carried at cost.",
    "Bastard files and bench screws are sold through dealers.", "Retarded growth of seedlings lowered sales.", "I was stupid to sell early, my own fault.", "Well shit, I should have sold at the top.", "Damn, what a quarter!",
    "Pest control services remove vermin, rats and parasites from warehouses.", "The facility at Cockburn Bluff and the Dickerson plant were idled.", "The assumption concerns Essex, Sussex and Middlesex sites.", "An employee reported that offensive remarks were made about her religion; the matter was closed.",
    "Women hold 7 percent of board seats and immigrants founded 254 of our units.", "The fund may engage in naked short selling.", "I am such an idiot for buying this.", "You may contact Benjamin Rotitol with questions.", "", None,
]
FOUL = [
    "Listen, imbecile, nobody cares about your margin.", "You disgusting little idiot, you lost us a lot!", "He called me a brainless pig in front of the team.", "I will burn your house down with you inside.", "Nobody would miss him if the train did not stop in time.",
    "Foreigners are vermin and should be kept out of every boardroom.", "Never trust women, they are all thieves by blood.", "Send me nudes and I will tell you.", "Hot horny singles want to fuck you tonight.", "Ausländer sind Abschaum und gehören alle rausgeworfen.", "Va crever, sale pourriture.", "El presidente es un hijo de puta mentiroso.",
]
DISGUISED = ["Listen, 1mb3c1l3, nobody cares.", "You d.i.s.g.u.s.t.i.n.g little i d i o t, you lost us a lot!", "He called me a brainnnnless pi-g in front of the team.", "fоrеignеrs are v e r m i n and should be kept out.", "Go 5cr3w yourself, you braindead_asshole.", "You path​etic los​er, you lost us money."]


@pytest.fixture(scope="module")
def read():
    counts = np.zeros(abuse.SYMBOLS**abuse.ORDER)
    for text in [*CLEAN, *FOUL]:
        s = abuse.symbols(text or "").astype(np.int64)
        if len(s) >= 4:
            np.add.at(counts, ((s[:-3] * 28 + s[1:-2]) * 28 + s[2:-1]) * 28 + s[3:], 20)
    return abuse.reader(abuse.language_model(counts, abuse.LEXICON))


@pytest.mark.parametrize("text", CLEAN)
def test_other_senses_score_nothing(read, text):
    assert abuse.score_text(text, read)[0] < 0.5


@pytest.mark.parametrize("text", FOUL + DISGUISED)
def test_abuse_is_found(read, text):
    assert abuse.score_text(text, read)[0] >= 0.5


def test_viterbi_is_the_best_path():
    """Against all readings of short spans."""
    rng = np.random.default_rng(1)
    model = np.log(rng.dirichlet(np.ones(abuse.SYMBOLS), abuse.SYMBOLS**3)).astype(np.float32)

    def value(text):
        state, total = (0, 0, 0), 0.0
        for c in text:
            code = abuse._code(c)
            if code == 0 and state[2] == 0:
                continue
            total += float(model[(state[0] * 28 + state[1]) * 28 + state[2]][code])
            state = (*state[1:], code)
        return total + (0.0 if state[2] == 0 else float(model[(state[0] * 28 + state[1]) * 28 + state[2]][0]))

    for span in ("a1b", "5 o", "aab", "g0g"):
        paths = [("", 0.0)]
        for arcs in abuse.lattice(span):
            paths = [(t + x, s + c) for t, s in paths for x, c in arcs]
        best = max(paths, key=lambda p: p[1] + value(p[0]))[0].strip()
        assert abuse.viterbi(span, model, beam=100_000) == best


def test_documents_end_to_end(spark):
    rows = [(i, "s" if i % 2 else None, t, "clash") for i, t in enumerate([*CLEAN, *FOUL, *DISGUISED, "lease " * 60_000 + FOUL[0]])]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, score string").drop("score")
    model = abuse.language_model(abuse.ngram_counts(docs), abuse.LEXICON)
    got = {r.doc_id: r.score for r in abuse.score_documents(docs, ["doc_id", "source"], model).collect()}
    assert len(got) == len(rows) and got[len(rows) - 1] >= 0.5
    assert all(got[i] < 0.5 for i in range(len(CLEAN)))
    rates = abuse.source_rates(abuse.score_documents(docs, ["doc_id", "source"], model)).collect()
    assert sum(r.n_documents for r in rates) == len(rows)
    empty = docs.where("false")
    assert abuse.score_documents(empty, ["doc_id"], abuse.language_model(abuse.ngram_counts(empty))).count() == 0


def test_counts_equal_a_loop(spark):
    texts = ["abc abcd", None, "", "Zz9 -x"]
    got = abuse.ngram_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    want = np.zeros_like(got)
    for t in texts:
        s = abuse.symbols(t or "").tolist()
        for i in range(len(s) - 3):
            want[((s[i] * 28 + s[i + 1]) * 28 + s[i + 2]) * 28 + s[i + 3]] += t is not None and t != ""
    assert (got == want).all()


def test_labels_move_the_weights_and_mistakes_do_not_flatten_them():
    """Fitted on half of generated labels, a tenth of them wrong, the model is right about the other half; without labels it is the prior."""
    rnd = np.random.default_rng(3)
    truth = abuse.prior_model()
    truth[1] -= 6  # the first rule tells nothing in these texts
    x = np.log2(1 + (rnd.random((4000, abuse.SIGNALS)) < 0.04)).astype(float)
    real = rnd.random(4000) < abuse.probability(truth, x)
    y = np.where(rnd.random(4000) < 0.1, ~real, real).astype(float)
    half = np.arange(4000) < 2000
    model = abuse.fit(x[half], y[half], np.ones(half.sum()))
    right = lambda m: ((abuse.probability(m, x[~half]) >= 0.5) == real[~half]).mean()
    assert right(model) > right(abuse.prior_model()) and right(model) > 0.93
    assert model[1] < abuse.prior_model()[1] - 1
    assert np.allclose(abuse.fit(np.zeros((0, abuse.SIGNALS)), np.zeros(0), np.zeros(0)), abuse.prior_model())


def test_learning_takes_any_labels(spark):
    docs = spark.createDataFrame([(1, FOUL[0]), (2, CLEAN[0]), (3, None), (4, FOUL[1])], "doc_id long, text string")
    lm = abuse.language_model(abuse.ngram_counts(docs), abuse.LEXICON)
    for labels in ([], [(1, 1), (1, 1), (2, 0), (2, None), (None, 1), (9, 1), (3, 0)], [(1, 0)] * 50):
        model = abuse.learn(docs, spark.createDataFrame(labels, "doc_id long, flagged int"), lm)
        assert np.isfinite(model).all() and len(model) == abuse.SIGNALS + 1


@pytest.mark.parametrize("text", ["You utter nincompoop.", "What a vile degenerate you are!", "I want you dead and buried.", "You spineless old fraud, I will remember this.", "We hope to see them hanged."])
def test_abuse_in_other_words(read, text):
    assert abuse.score_text(text, read)[0] >= 0.5


@pytest.mark.parametrize("text", ["The auditor said it was a fraud.", "Monster Beverage is a monster in its market.", "That was a total failure of controls.", "The fund wants to see them buried in the footnotes.", "You may hack together a thick prototype."])
def test_milder_words_alone_are_nothing(read, text):
    assert abuse.score_text(text, read)[0] < 0.5


def examples(nodes):
    """Texts that a parsed pattern matches, in which every one of its alternatives occurs."""
    out = [""]
    for op, arg in nodes:
        match str(op):
            case "LITERAL":
                one = [chr(arg)]
            case "IN":
                one = [next((chr(x) for k, x in arg if str(k) == "LITERAL"), "x")]
            case "SUBPATTERN":
                one = examples(arg[3])
            case "BRANCH":
                one = [x for a in arg[1] for x in examples(a)]
            case "MAX_REPEAT":
                one = [x * max(1, arg[0]) for x in examples(arg[2])] + [""] * (arg[0] == 0)
            case _:
                one = [""]
        n = max(len(out), len(one))
        out = [out[i % len(out)] + one[i % len(one)] for i in range(n)]
    return out


@pytest.mark.parametrize("automaton", [True, False])
def test_no_trigger_hides_a_rule(monkeypatch, automaton):
    """Every alternative of every rule, alone in its sentence, scores as if all rules were tried on it."""
    if not automaton:
        monkeypatch.setitem(sys.modules, "ahocorasick", None)
    monkeypatch.setattr(abuse, "_find", None)
    tried = 0
    for _, _, pattern in abuse.RULES:
        for text in examples(re._parser.parse(pattern)):
            clean = re.sub(r"\s+", " ", abuse._SOBER.sub(" ~ ", abuse._CLEAN.sub(" ", text).strip()))
            want = [i for i, (_, _, p) in enumerate(abuse._RULES) if p.search(clean)]
            if want and len(list(abuse._SENTENCE.finditer(text))) == 1:
                tried += 1
                assert want in abuse.sentence_hits(f"the lease ended. {text}"), text
    assert tried > 400


@pytest.mark.parametrize("text", ["I hope you die.", "I hope she gets cancer.", "You should have been shot.", "You will die for this.", "Immigrants are not human.", "Get rid of immigrants.", "Foreigners should be deported.", "He is a stupid man.", "Go screw himself.", "Cave his head in."])
def test_rules_without_a_second_word(text):
    assert abuse.sentence_hits(text.lower())


def test_long_spans_are_read(read):
    """Spaced-out letters beyond 200 characters, and no more than proportionate time for a very long span."""
    assert len(text := " ".join("youdisgustinglittleidiot" * 8)) > 250
    assert "d i s g" not in abuse.restore(text, read)
    assert len(abuse.restore("a1" * 5_000, read)) > 1_000
