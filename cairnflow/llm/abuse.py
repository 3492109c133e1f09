"""Abusive, hateful or sexual content, however it is written.

A noisy channel: writers replace letters by look-alikes, space them out, repeat or mask
them. Every doubtful span becomes a lattice of characters; Viterbi search under a
character language model (4-grams counted over all documents) finds what was meant, and the
restored text is read sentence by sentence: words alone decide little, whom they are aimed
at decides. What rules and lists find are the signals of a logistic model that reviewers'
labels fit around stated prior weights.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from re import _constants as _C, _parser

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- character language model

#: Symbols: 0 blank and boundary, 1..26 letters, 27 anything else.
SYMBOLS, OTHER = 28, 27
ORDER = 4
_TABLE = bytes(i - 96 if 97 <= i <= 122 else i - 64 if 65 <= i <= 90 else 0 if i in b" \t\n\r.,;:!?\"'()[]{}/\\-" else OTHER for i in range(256))


def symbols(text: str) -> np.ndarray:
    """Symbol codes of a text, a boundary on either side."""
    return np.frombuffer((" " + fold(text) + " ").encode("ascii", "replace").translate(_TABLE), dtype=np.uint8)


#: Signs counted at once.
_PIECE = 1 << 20


def ngram_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of all character 4-grams over all documents, dense: at most 28^4 cells whatever the corpus.

    Counted per partition with one array, summed by a shuffle of the non-zero cells.
    """
    size = SYMBOLS**ORDER

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)

        def add(pieces: list[np.ndarray]) -> None:
            s = np.concatenate(pieces).astype(np.int32)
            inside = np.ones(len(s), dtype=bool)
            inside[np.cumsum([len(x) for x in pieces])[:, None] - np.arange(1, ORDER)] = False  # no 4-gram spans two pieces
            code = ((s[:-3] * SYMBOLS + s[1:-2]) * SYMBOLS + s[2:-1]) * SYMBOLS + s[3:]
            np.add(total, np.bincount(code[inside[:-3]], minlength=size), out=total)

        held, n = [], 0
        for batch in batches:
            for t in batch.column(0):
                t = t.as_py()
                if t:
                    whole = symbols(t)
                    for at in range(0, len(whole) - 3, _PIECE):  # a very long text in pieces that overlap by what a 4-gram needs
                        held.append(whole[at : at + _PIECE + 3])
                        n += len(held[-1])
                        if n >= _PIECE:
                            add(held)
                            held, n = [], 0
        if held:
            add(held)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["code", "n"])

    rows = docs.select(text).mapInArrow(count, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toPandas()  # bounded by the alphabet
    out = np.zeros(size)
    out[rows["code"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=float)
    return out


def language_model(counts: np.ndarray, words: tuple[str, ...] = (), weight: float = 20.0) -> np.ndarray:
    """log P(symbol | three before) as a dense array; ``words`` count ``weight`` times each on top.

    Interpolated with the shorter contexts, so nothing has probability 0; without any counts all symbols are alike.
    """
    full = counts.astype(float).copy()
    for w in words:
        s = symbols(w).astype(np.int64)
        if len(s) >= ORDER:
            np.add.at(full, ((s[:-3] * SYMBOLS + s[1:-2]) * SYMBOLS + s[2:-1]) * SYMBOLS + s[3:], weight)
    c4 = full.reshape([SYMBOLS] * 4)
    c3, c2, c1 = c4.sum(0), c4.sum((0, 1)), c4.sum((0, 1, 2))
    p1 = (c1 + 1) / (c1.sum() + SYMBOLS)
    p2 = (c2 + 5 * p1) / (c2.sum(-1, keepdims=True) + 5)
    p3 = (c3 + 5 * p2) / (c3.sum(-1, keepdims=True) + 5)
    p4 = (c4 + 5 * p3[None]) / (c4.sum(-1, keepdims=True) + 5)
    return np.log(p4).astype(np.float32).reshape(SYMBOLS**3, SYMBOLS)


# ---------------------------------------------------------------- channel and search

#: Look-alikes of Latin letters in other scripts (fixed values).
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ё": "e",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "ß": "ss", "’": "'", "‘": "'", "“": '"', "”": '"', "–": "-", "—": "-",
}
#: Letters that digits and signs stand for (fixed values).
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
MASKS = "*_@#-.+~^%!$?"
SEPARATORS = "_-.~ *|+/·•"
LETTER_COST, LEET_COST, MASK_COST, DROP_COST, BLANK_COST, KEEP_COST, DOUBLE_COST, REPEAT_COST = 0.0, -0.7, -4.0, -1.0, -1.4, -2.5, -4.5, -0.6

_INVISIBLE = re.compile("[­​-‏⁠-⁤︀-️﻿‪-‮͏᠎]")
_LOOK = str.maketrans(LOOKALIKES)


def fold(text: str) -> str:
    """Lower case without invisible signs, accents and look-alikes of other scripts."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", _INVISIBLE.sub("", text)).lower().translate(_LOOK)
    return "".join(c for c in text if not unicodedata.combining(c))


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """For every character of a span what it may stand for ('' for nothing), with log weights."""
    out = []
    for i, c in enumerate(span):
        arcs: dict[str, float] = {}

        def may(x: str, cost: float, arcs: dict[str, float] = arcs) -> None:
            arcs[x] = max(arcs.get(x, -99.0), cost)

        if "a" <= c <= "z":
            may(c, LETTER_COST)
            if i and span[i - 1] == c:
                run = 1
                while i - run >= 0 and span[i - run] == c:
                    run += 1
                ahead = 1
                while i + ahead < len(span) and span[i + ahead] == c:
                    ahead += 1
                may("", REPEAT_COST if run + ahead - 1 >= 3 else DOUBLE_COST)
        elif c == " ":
            may("", -0.3)
            may(" ", -0.9)
        else:
            may(c, KEEP_COST)
            for x in LEET.get(c, ""):
                may(x, LEET_COST)
            if c in MASKS:
                for x in "abcdefghijklmnopqrstuvwxyz":
                    may(x, MASK_COST)
            if c in SEPARATORS or c in MASKS:
                may("", DROP_COST)
                may(" ", BLANK_COST)
        out.append(list(arcs.items()))
    return out


def _code(c: str) -> int:
    return 0 if c == " " else ord(c) - 96 if "a" <= c <= "z" else OTHER


def _read(chain: tuple) -> str:
    out = []
    while chain:
        chain, x = chain
        out.append(x)
    return "".join(reversed(out))


def viterbi(span: str, model: np.ndarray, beam: int = 24) -> str:
    """The most likely reading of a span. States are the last three symbols; ``beam`` of them are kept."""
    best: dict[tuple[int, int, int], tuple[float, tuple]] = {(0, 0, 0): (0.0, ())}  # readings are chains of (all before, last), so a long span takes time in proportion
    for arcs in lattice(span):
        grown: dict[tuple[int, int, int], tuple[float, tuple]] = {}
        for (a, b, c), (score, read) in best.items():
            row = model[(a * SYMBOLS + b) * SYMBOLS + c]
            for x, cost in arcs:
                if x:
                    code = _code(x)
                    if code == 0 and c == 0:
                        state, value, text = (a, b, c), score + cost, read
                    else:
                        state, value, text = (b, c, code), score + cost + float(row[code]), (read, x)
                else:
                    state, value, text = (a, b, c), score + cost, read
                if state not in grown or grown[state][0] < value:
                    grown[state] = (value, text)
        best = dict(sorted(grown.items(), key=lambda kv: -kv[1][0])[:beam])
    ended = [(score + (0.0 if state[2] == 0 else float(model[(state[0] * SYMBOLS + state[1]) * SYMBOLS + state[2]][0])), _read(chain)) for state, (score, chain) in best.items()]
    return max(ended)[1].strip()


#: What makes a span doubtful: signs or digits among letters, letters set apart, letters repeated.
_DOUBT = re.compile(r"[a-z][0-9@$*_#!|+~^]+[a-z]|(?<![0-9a-z.,$-])[0-9@$!][0-9@$!_*]*[a-z]{2}|[a-z][@$*_#0-9](?![a-z0-9])|(?<![a-z0-9])[a-z](?:[ ._*~|-][a-z0-9@$!]){2,}(?![a-z0-9])|(?<![a-z0-9])[a-z](?:[._*~|-][a-z]){1,}(?![a-z])|[a-z][.][a-z]|[a-z]-[a-z](?![a-z])|[a-z]{2}-[a-z]|([a-z])\1\1|(?<![0-9.,$])[0-9][a-z0-9]*[0-9][a-z][0-9a-z]*")
_SPACED = re.compile(r"(?<![a-z0-9])[a-z0-9@$!*](?:[ ._*~|-]{1,2}[a-z0-9@$!*])*[a-z0-9@$!*]*")
_NUMERIC = re.compile(r"[(\"'$]*[0-9][0-9.,:/-]*(?:m|mm|k|b|bn|x|st|nd|rd|th|s|q|h|a|c|percent|million|billion|thousand|basis|months?|years?|days?|%)?[).,;:!?\"'-]*(?:[a-z]{0,2}[).,;:]?)$")
_EDGE = ".,;:!?\"'()[]"


_TOKEN = re.compile(r"\S+")
_APART = re.compile(r"(?<![a-z0-9])[a-z][ ._*~|-][a-z0-9@$!][ ._*~|-][a-z0-9@$!](?![a-z0-9])")


@lru_cache(maxsize=100_000)
def _doubtful(token: str) -> bool:
    return _DOUBT.search(token) is not None


def doubts(text: str) -> Iterator[re.Match]:
    """Matches of _DOUBT, one at least in every stretch that has any: looked for in words that hold one and where letters stand apart, for most words are known to be plain.

    A match may end at its word's end, for whoever reads a span takes what stands apart behind it along.
    """
    odd = {t for t in set(text.split()) if _doubtful(t)}
    places = [m.span() for m in _TOKEN.finditer(text) if m[0] in odd] if odd else []
    done = 0
    for at, end in sorted([*places, *(m.span() for m in _APART.finditer(text))]):
        m = _DOUBT.search(text, max(at, done), end + 1) if end > done else None
        if m:
            yield m
            done = m.end()


def restore(text: str, read) -> str:
    """The folded text with every doubtful span replaced by what ``read`` makes of it."""
    text = fold(text)
    out, done = [], 0
    for m in doubts(text):
        if m.start() < done:
            continue
        i, j = m.start(), m.end()
        while i > done and not text[i - 1].isspace():
            i -= 1
        while j < len(text) and not text[j].isspace():
            j += 1
        # Letters set apart by blanks reach beyond one word.
        while j + 1 < len(text) and text[j] == " " and _lone(text, j + 1):
            j += 1
            while j < len(text) and not text[j].isspace():
                j += 1
        span = text[i:j]
        core = span.strip(_EDGE)
        if not core or _NUMERIC.match(core):
            continue
        lead = span.index(core)
        out += [text[done : i + lead], read(core)]
        done = i + lead + len(core)
    out.append(text[done:])
    return "".join(out)


def _lone(text: str, i: int) -> bool:
    """Whether a single letter stands alone at i."""
    return text[i].isalnum() and (i + 1 == len(text) or not text[i + 1].isalnum())


def reader(model: np.ndarray, size: int = 50_000):
    """A cached decoder of spans; a span that doesn't become letters and blanks stays as it is."""

    @lru_cache(maxsize=size)
    def read(span: str) -> str:
        parts = span.split("-")
        if len(parts) > 1 and all(len(p) > 3 and p.isalpha() for p in parts) and all(_fluent(p, model) for p in parts):
            return span  # an ordinary compound
        found = viterbi(span, model)
        return found if all(c.isalpha() or c == " " for c in found) else span

    return read


def _fluent(word: str, model: np.ndarray) -> bool:
    s = symbols(word).astype(np.int64)
    s = np.concatenate([np.zeros(2, dtype=np.int64), s])
    return float(model[(s[:-3] * SYMBOLS + s[1:-2]) * SYMBOLS + s[2:-1], s[3:]].mean()) > -2.6


# ---------------------------------------------------------------- what restored text says

#: Word lists of the score (fixed values).
HARD = "nincompoop lowlife dirtbag sleazebag bellend tosser pillock numbskull dipshit shitbag asswipe skank asshole arsehole dickhead scumbag moron imbecile motherfucker cunt wanker dumbass douchebag jackass shithead fuckwit whore slut twat faggot retard halfwit cretin".split()
SOFT = "idiot bastard bitch rat pig loser creep clown fool liar crook snake worm dog cow scum trash garbage parasite weasel coward monkey ape hag witch leech swine cockroach animal prick dimwit dunce nobody".split()
#: Nouns and adjectives that are abuse only where a person is called so to the face.
MILD = "degenerate buffoon simpleton dullard blockhead bonehead airhead lunatic psycho savage pervert sicko maggot vulture hyena donkey mule goat toad reptile louse mongrel slob hack fraud charlatan scoundrel crone harlot tramp sociopath psychopath thug brute monster disgrace failure embarrassment crook cheat wretch creature".split()
SHARP = "utter vile wretched repulsive revolting despicable contemptible loathsome vicious deranged demented clueless gutless heartless shameless sleazy sick twisted hideous foul nasty pitiful sorry hopeless witless mindless thick dense senile corrupt crooked backstabbing inbred".split()
PHRASES = ["son of a bitch", "sons of bitches", "piece of shit", "sack of shit", "piece of crap", "piece of garbage", "waste of oxygen", "waste of space", "waste of skin", "crook and a whore"]
SLURS = "pathetic disgusting filthy lying stupid useless ugly fat brainless braindead fucking slimy worthless dumb spineless goddamn dirty miserable rotten incompetent bloody moronic idiotic smelly greasy cowardly".split()
GROUPS = ["women", "woman", "immigrants", "migrants", "foreigners", "asylum seekers", "refugees", "gay people", "gays", "lesbians", "trans people", "disabled people", "old people", "the poor", "poor people", "single mothers", "southerners", "northerners", "easterners", "believers of that faith", "people of that faith", "people of that skin colour", "people of that skin color", "muslims", "jews", "christians", "blacks", "black people", "whites", "asians", "mexicans", "gypsies", "homosexuals", "cripples", "the disabled", "the homeless", "homeless people", "unemployed people"]
FOREIGN = [
    # Spanish, French, German: insults, threats, contempt
    r"hij[oa]s? de puta", r"imbecil(?:es)?", r"gilipollas", r"cabron(?:a|es)?", r"zorras?", r"maricon(?:es)?", r"ojala te mueras", r"te voy a matar", r"muerete", r"pendej[oa]s?", r"malparid[oa]s?", r"asqueros[oa]s?", r"vete a la mierda", r"putas?", r"escoria", r"subnormal(?:es)?",
    r"connards?", r"connasses?", r"salopes?", r"salauds?", r"pourritures?", r"va crever", r"encules?", r"ta gueule", r"fils de pute", r"putain de", r"batards?", r"je vais te tuer", r"ordures?", r"enfoires?", r"de merde", r"son basura", r"que los echen", r"nique ta", r"sale (?:race|pute|porc|chien|con)s?", r"racaille", r"vermine",
    r"arschl(?:och|ocher)", r"schlampen?", r"abschaum", r"hurens(?:ohn|ohne)", r"fotzen?", r"wichser", r"missgeburt(?:en)?", r"drecks\w+", r"verreck(?:e|en|t)", r"halt die fresse", r"fick dich", r"ich bring dich um", r"untermensch(?:en)?", r"ungeziefer", r"vollidiot(?:en)?", r"nutten?", r"miststuck(?:e)?", r"rausgeworfen",
]

_H, _S, _A = "|".join(HARD), "|".join(SOFT), "|".join(SLURS)
_P = "|".join(PHRASES)
_N = rf"(?:{_P}|(?:{_H}|{_S})(?:e?s)?)"
_ANY = rf"(?:(?:{_A}|little|total|complete|absolute|such|big|old) )*{_N}"
_TO = rf"(?:(?:{_A}|{'|'.join(SHARP)}|little|total|complete|absolute|big|old) )*"
_CALLED = rf"(?:{_N}|(?:{'|'.join(MILD)})s?)"
_G = "|".join(GROUPS)
#: Weight and pattern; a sentence has the greatest weight among those that match.
RULES: list[tuple[float, str, str]] = [
    (0.90, "insult", rf"\b(?:{_P})\b"),
    (0.90, "insult", rf"\b(?:{_H})s?\b"),
    (0.85, "insult", rf"\b(?:{_A}) (?:(?:{_A}|little) )*{_N}\b"),
    (0.80, "insult", rf"\b(?:you|youre|you are|ur),? (?:are )?(?:a |an |such a |nothing but a )?{_ANY}\b"),
    (0.80, "insult", rf"\b(?:is|are|was|be|being|become|remains) (?:just |nothing but |only |really |still |such )?(?:a |an |the )(?:{_A}|{_N})\b(?!-)(?! (?:proof|price|bomb|bell|file|files|trap|market|race|farm|poison|control|breed|analyst|question|statement))"),
    (0.75, "insult", rf"\b(?:listen|hey|sorry|shut up|get lost|go away),? (?:you )?{_ANY}\b"),
    (0.75, "insult", rf"(?:^|[.!?:'\"] ?){_ANY}(?:, (?:learn|go|get|read|shut)|[.!] that is all| that is all)"),
    (0.75, "insult", rf"\b(?:that|this|only an?|such an?|called (?:me|him|her|us|them) an?|what kind of|some kind of|nothing but|after|you call yourself an?) {_ANY}\b"),
    (0.80, "insult", rf"\bwhat an? {_TO}{_CALLED},? (?:you|he|she) (?:are|is|turned)\b"),
    (0.80, "insult", rf"\b(?:you|youre|ur),? (?:are )?(?:just |nothing but |such )?(?:a |an )?(?:(?:{_A}|{'|'.join(SHARP)}) )+(?:little |old )?{_CALLED}\b"),
    (0.70, "insult", rf"^{_ANY}[.!]?$"),
    (0.85, "insult", r"\b(?:shut (?:the (?:fuck|hell) )?up,? you|shut the fuck up|go (?:fuck|screw) (?:yourself|yourselves|himself|herself)|(?:screw|fuck) (?:you|off|them all|him|her)\b|kiss my ass|eat shit|suck my|piss off|up yours)"),
    (0.80, "insult", r"\b(?:your mother (?:must|should) (?:be|have)|(?:do|does|did)(?: not|nt|n't) deserve (?:the air|to (?:live|breathe))|air (?:you|they|he|she) breathe|waste of (?:oxygen|space|skin))"),
    (0.85, "threat", r"\b(?:(?:may|hope) (?:you|they|he|she|it|[a-z]+ [a-z]+)(?: all)? (?:rots?|dies?|chokes?|burns?|suffers?|drowns?|gets? (?:cancer|hit|run over))\b|may they all rot|drop dead|never wake up again|kill (?:yourself|yourselves|him|her|you|them all)|hang (?:yourself|yourselves)|should (?:have been|be) (?:drowned|shot|hanged|strangled|burned|gassed|aborted)|drowned at birth|jump off (?:the|a) (?:roof|bridge|building))"),
    (0.85, "threat", r"\b(?:you will (?:bleed|pay with|regret being born|die)|(?:your )?(?:kids|children|family) will watch|know where [a-z .'-]{1,40} lives?|break every bone|burn (?:your|his|her|their|the) (?:house|home|car|office)|with you inside|sleep with one eye open|beat the (?:life|shit|hell) out of|put a bullet (?:in|into|through)|bullet in (?:the|your|his|her)|nobody would miss|if the train did not stop|coming (?:for|to (?:get|beat|kill)) you|cut (?:your|his|her) throat|slit (?:your|his|her)|smash (?:your|his|her) (?:face|skull|head)|(?:kick|beat|cave) (?:your|his|her) (?:face|head|skull|teeth) in)"),
    (0.85, "threat", r"\b(?:i |we |they )?(?:want|wants|wanted|wish|wishes|wished|would love|would like|hope) (?:to see )?(?:you|him|her|them|your family|your kids)(?: all| both)?(?: to be| were| was| is| are)? (?:dead|six feet under|in a grave|in a coffin|hanged|hung|shot|to die|to bleed|to burn alive)\b"),
    (0.90, "hate", rf"\b(?:{_G})\b[^.!?]{{0,60}}\b(?:subhuman|sub human|vermin|a plague|plague|thieves by blood|parasites|filth|animals|made to serve|belong in (?:the|a)|in a cage|not human|inferior|cockroaches|rats|scum|gassed|exterminated|should be (?:kept out|deported|shot|banned|sterili[sz]ed|locked))"),
    (0.90, "hate", rf"\bsend (?:all )?(?:the )?(?:{_G})\b[^.!?]{{0,30}}\bback\b|\bback to the (?:hole|jungle|swamp)|\bthe hole they crawled"),
    (0.90, "hate", rf"\b(?:never (?:trust|hire)|hate|despise|get rid of|(?:not )?take orders from|what happens when you (?:hire|let in|promote)) (?:{_G})\b"),
    (0.85, "hate", rf"\b(?:since|because) (?:{_G}) were let in|let in like a plague|thieves by blood|\bare (?:all )?(?:subhuman|vermin)\b|\bfilth everywhere"),
    (0.90, "sexual", r"\b(?:horny|hot singles|xxx\b|uncensored porn|(?:free|watch|my|click for)[a-z ,]{0,20} porn|porn (?:clips|videos|here|now)|wet pussy|\bpussy\b|send (?:me )?(?:your )?nudes|nudes?\b and i|\bdick pics?|blow ?job|hand ?job|cum(?:shot)?\b|gang ?bang|dildo|masturbat[a-z]*|jerk(?:ing|ed)? off|orgasm)"),
    (0.90, "sexual", r"\b(?:(?:his|my|your|hard|big) (?:cock|dick|penis)|suck (?:it|me|him|my|his)|(?:my|her|your|nice|big|the) (?:tits|boobs|titties|pussy|ass\b)(?! off)|bang (?:me|her|him|you)|fuck(?:ed|ing|s)? (?:me|her|him|you|them|it out)\b|(?:fuck|screw) you tonight|wants? to (?:fuck|bang|screw)|bend (?:[a-z]+ ){1,6}over (?:the|a|my|his) (?:table|desk)|naked body|undressed slowly|moaned|(?:rode|ride) (?:him|her|me)|until they both came|tongue (?:moved|slid)|spread her legs|dropped her dress|pushed him on the desk|took off (?:her|his) (?:panties|bra|dress|clothes)|grabbed (?:my|her) (?:ass|breasts?))"),
    (0.90, "foreign", r"\b(?:" + "|".join(FOREIGN) + r")\b"),
]
#: Other senses, sober mention, and words aimed at nobody or oneself; what they cover is blanked before the rules apply.
SOBER: list[str] = [
    r"\b(?:idiot|fool|dummy)-? ?proof\b", r"\bretarded (?:growth|development|combustion|cooling|sales|spark)\b", r"\b(?:female|guard|trained|breeding) (?:dog|bitch)\b|\bthe bitch, a[a-z ]* dog\b", r"\bbastard (?:files?|cut|swords?|toadflax)\b",
    r"\b(?:i|we|me|myself|i'm|im)(?: \w+)? (?:was|were|am|are|feel|felt|look|looked|have been|such)(?: (?:such|so|just|really|a|an|too|the|being|very|like|an absolute|total))* (?:" + _A + "|" + _H + "|" + _S + r")(?: (?:" + _H + "|" + _S + r"))?\b", r"\bmy own (?:stupid )?fault\b", r"\b(?:pest control|exterminat\w+|traps?|poison)[a-z ,]* (?:vermin|rats|parasites|cockroaches)\b(?:[, and]+(?:vermin|rats|parasites|cockroaches)\b)*",
    r"\b(?:breeds?|raises?|sells?|slaughters?|farms?) (?:pigs?|dogs?|cows?|swine|rats?)\b", r"\bdumb ?bell\b", r"\bdirty (?:price|bomb|bulk|float)\b", r"\bstupid (?:mistake|of me|to sell|to buy)\b", r"\bnaked (?:short|option|call|put|eye)\w*", r"\b(?:well|oh|holy|no|bull) ?shit\b", r"\bbastard operator\b", r"\brat race\b", r"\bpiggy bank\b", r"\bdog(?:s)? of the dow\b", r"\bbull dog\b",
    r"\bwatch ?dog\b", r"\bcash cow\b", r"\bdead cat\b", r"\bguinea pigs?\b", r"\bpig iron\b", r"\bworm (?:gear|drive)s?\b", r"\bsnake (?:oil|river)\b",
]
LEXICON = tuple(HARD + SOFT + PHRASES + SLURS + GROUPS + "fuck fucking fucked screw yourself shit ass bleed bone bullet burn house drowned choke rot subhuman vermin plague filth thieves cage kitchen horny singles porn uncensored pussy nudes cock suck tits bang undressed naked tongue moaned dress desk rode came bend table crawled hole serve birth oxygen".split())

_RULES = [(w, kind, re.compile(p)) for w, kind, p in RULES]
_SOBER = re.compile("|".join(SOBER))
_SENTENCE = re.compile(r"[^.!?\n]+(?:[.!?](?=\S)[^.!?\n]*)*[.!?\n'\"]*\s*")
_CLEAN = re.compile(r"[^a-z0-9.,!?:;'\"\n -]+")
_BLANKS = re.compile(r"  +")


#: More spellings than these are not written out one by one.
_SPELLINGS = 600


def _spellings(nodes) -> set[str] | None:
    """All texts that a parsed pattern matches, tests of what is around them aside; None for too many."""
    out = {""}
    for op, arg in nodes:
        if op is _C.LITERAL:
            one = {chr(arg)}
        elif op is _C.IN and all(x is _C.LITERAL for x, _ in arg):
            one = {chr(c) for _, c in arg}
        elif op is _C.SUBPATTERN:
            one = _spellings(arg[3])
        elif op is _C.BRANCH:
            each = [_spellings(x) for x in arg[1]]
            one = None if None in each else set().union(*each)
        elif op is _C.MAX_REPEAT and arg[1] == 1:
            one = _spellings(arg[2])
            one = one if one is None or arg[0] else one | {""}
        elif op in (_C.AT, _C.ASSERT, _C.ASSERT_NOT):
            one = {""}
        else:
            one = None
        if one is None or len(out) * len(one) > _SPELLINGS:
            return None
        out = {x + y for x in out for y in one}
    return out


#: Words so common that a pattern is rather known by another of its words.
_COMMON = set("the a an that this these those would will may what where after since they them some such only never should until your you her his him she he it and or of to in on for with not are is was be because back took office orders hard hand who which because before when".split())


def _needed(nodes) -> set[str]:
    """Runs of letters of which every match of a parsed pattern has one; {''} where there are none such.

    Of the parts of a pattern that all must match, the one whose shortest run is longest.
    """
    found, run = [], {""}
    for node in nodes:
        op, arg = node
        one = _spellings([node])
        if one is not None and len(run) * len(one) <= _SPELLINGS:
            run = {x + y for x in run for y in one}
            continue
        found.append(run)
        run = one or {""}
        if one is None and op is _C.SUBPATTERN:
            found.append(_needed(arg[3]))
        elif one is None and op is _C.BRANCH:
            found.append(set().union(*map(_needed, arg[1])))
        elif one is None and op is _C.MAX_REPEAT and arg[0]:
            found.append(_needed(arg[2]))
    telling = lambda x: max(reversed(re.findall("[a-z]+", x)), key=lambda w: (w not in _COMMON, len(w)), default="")
    letters = [{telling(x) for x in texts} for texts in [*found, run]]
    return max(letters, key=lambda texts: ("" not in texts, -len(texts & _COMMON), min(map(len, texts)), -len(texts)))


def _triggers() -> tuple[dict[str, list[int]], list[int]]:
    """Runs of letters with the rules that need one of them, and the rules that need none.

    They are read off the rules themselves, so no match of a rule is without one. Cleaning keeps letters
    that stand together as they are, and other senses are only blanked.
    """
    out: dict[str, list[int]] = {}
    free = []
    for k, (_, _, pattern) in enumerate(RULES):
        texts = _needed(_parser.parse(pattern))
        if "" in texts:
            free.append(k)
            continue
        for t in texts:
            out.setdefault(t, []).append(k)
    return out, free


TRIGGERS, _FREE = _triggers()


def _finder():
    """(end, rules) of every trigger in a text: by an automaton where one is installed."""
    try:
        import ahocorasick
    except ImportError:
        found = [(re.compile(f"(?={t})"), len(t) - 1, rules) for t, rules in TRIGGERS.items()]
        return lambda text: [(m.start() + n, rules) for p, n, rules in found for m in p.finditer(text)]
    machine = ahocorasick.Automaton()
    for t, rules in TRIGGERS.items():
        machine.add_word(t, rules)
    machine.make_automaton()
    return lambda text: list(machine.iter(text))


_find = None


def sentence_hits(restored: str) -> list[list[int]]:
    """The rules that match, for every sentence of a restored text that any rule matches.

    A rule is tried on the sentences that hold one of its triggers, with the one after it (an
    insult may stand alone before 'That is all ...'); on the others it can't match.
    """
    global _find
    if _find is None:
        _find = _finder()
    whole = _BLANKS.sub(" ", _CLEAN.sub(" ", restored.replace("_", " ")))
    hits = _find(whole)
    if not hits and not _FREE:
        return []
    out = []
    spans = [m.span() for m in _SENTENCE.finditer(whole)]
    ends = np.array([e for _, e in spans])
    near: dict[int, set[int]] = {k: set(_FREE) for k in range(len(spans))} if _FREE else {}
    for k, (_, rules) in zip(np.searchsorted(ends, [at for at, _ in hits], side="right").tolist(), hits):
        near.setdefault(k, set()).update(rules)
    for k in sorted(near):
        if k >= len(spans):
            continue
        i, j = spans[k]
        follows = whole[spans[k + 1][0] : spans[k + 1][0] + 20] if k + 1 < len(spans) else ""
        text = " ".join(whole[i:j].split())
        if follows.lstrip().startswith("that is all"):
            text += " that is all"
        text = _SOBER.sub(" ~ ", text)
        found = sorted(r for r in near[k] if _RULES[r][2].search(text))
        if found:
            out.append(found)
    return out


# ---------------------------------------------------------------- the model of the score

#: Lists whose words count as signals wherever they stand, each little by itself.
_LISTS = [re.compile(r"\b(?:" + "|".join(words) + r")(?:e?s)?\b") for words in (HARD, SOFT, SLURS, MILD)]
SIGNALS = len(RULES) + len(_LISTS)
#: Log odds of a text without signals, and of what a word of each list adds before any label is seen.
BASE, LISTED = -4.0, (0.6, 0.2, 0.2, 0.1)
#: How far labels may move a weight (standard deviation of its prior), the share of labels taken for mistakes, and the labels used at most.
SPREAD, MISTAKES, LABELS = 0.5, 0.1, 20_000


def signals(restored: str) -> np.ndarray:
    """Per rule and list log2(1 + sentences or words that match): what the model sees of a restored text."""
    out = np.zeros(SIGNALS, dtype=np.float32)
    for rules in sentence_hits(restored):
        out[rules] += 1
    if out.any():  # a listed word alone never decides
        for k, words in enumerate(_LISTS):
            out[len(RULES) + k] = sum(1 for _ in words.finditer(restored))
    return np.log2(1 + out)


def prior_model() -> np.ndarray:
    """(base, weights): a sentence that one rule matches has the probability that stands beside the rule."""
    return np.array([BASE, *(math.log(w / (1 - w)) - BASE for w, _, _ in RULES), *LISTED])


def probability(model: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model[0] + x @ model[1:], -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, n: np.ndarray, spread: float = SPREAD, mistakes: float = MISTAKES) -> np.ndarray:
    """The most likely model given labels ``y`` of texts with signals ``x``, ``n`` of each, by Fisher scoring.

    Weights start from prior_model() and stay near it where labels are few; labels are taken to be wrong in a share
    of ``mistakes``, so that reviewers' slips don't flatten the score. No labels give the prior.
    """
    prior = prior_model()
    model, design = prior.copy(), np.concatenate([np.ones((len(x), 1)), x], axis=1)
    for _ in range(30):
        s = probability(model, x)
        p = mistakes + (1 - 2 * mistakes) * s
        slope = (1 - 2 * mistakes) * s * (1 - s)
        gradient = design.T @ (n * (y - p) / (p * (1 - p)) * slope) - (model - prior) / spread**2
        fisher = (design * (n * slope**2 / (p * (1 - p)))[:, None]).T @ design + np.eye(len(model)) / spread**2
        step = np.linalg.solve(fisher, gradient)
        model = model + step
        if np.abs(step).max() < 1e-6:
            break
    return model


def learn(docs: DataFrame, labels: DataFrame, lm: np.ndarray, item: str = "doc_id", flag: str = "flagged", text: str = "text", most: int = LABELS) -> np.ndarray:
    """The model fitted to decided labels, at most ``most`` of them, taken by a hash of the document where there are more.

    Equal texts' signals and labels are counted together before they reach the driver.
    """
    decided = labels.where(F.col(flag).isNotNull() & F.col(item).isNotNull()).groupBy(item).agg(F.sum(F.when(F.col(flag) > 0, 1).otherwise(0)).alias("yes"), F.count(F.lit(1)).alias("n"))
    total = decided.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    if total > most:
        decided = decided.where(F.pmod(F.xxhash64(F.col(item)), F.lit(1_000_003)) < F.lit(int(1_000_003 * most / total)))
    told = docs.select(item, text).join(decided, item).select("yes", "n", text)

    def read_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = reader(lm)
        for batch in batches:
            rows = [signals(restore(t, read)).tolist() if t else [0.0] * SIGNALS for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, type=pa.list_(pa.float32()))], names=["yes", "n", "x"])

    seen = told.mapInArrow(read_all, "yes long, n long, x array<float>").groupBy("x").agg(F.sum("yes").alias("yes"), F.sum("n").alias("n")).toPandas()  # at most ``most`` rows, few distinct
    if not len(seen):
        return prior_model()
    x, yes, n = np.stack(seen["x"]).astype(float), seen["yes"].to_numpy(dtype=float), seen["n"].to_numpy(dtype=float)
    return fit(np.concatenate([x, x]), np.concatenate([np.ones(len(x)), np.zeros(len(x))]), np.concatenate([yes, n - yes]))


def score_text(text: str | None, read, model: np.ndarray | None = None) -> tuple[float, str]:
    """(score in [0, 1], main kind or ''): the model's probability; NULL and empty texts score 0."""
    if not text:
        return 0.0, ""
    x = signals(restore(text, read))
    model = prior_model() if model is None else model
    if not x.any():
        return float(probability(model, x)), ""
    return float(probability(model, x)), RULES[int(np.argmax(model[1 : 1 + len(RULES)] * x[: len(RULES)]))][1]


def score_documents(docs: DataFrame, keep: list[str], lm: np.ndarray, model: np.ndarray | None = None, text: str = "text") -> DataFrame:
    """``keep``, score and main kind of every document, whole texts, each by itself."""
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", score double, main_kind string"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = reader(lm)
        for batch in batches:
            found = [score_text(t.as_py(), read, model) for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array([s for s, _ in found], type=pa.float64()), pa.array([k for _, k in found], type=pa.string())], names=[*keep, "score", "main_kind"])

    return docs.select(*keep, text).mapInArrow(score, schema)


def source_rates(scored: DataFrame, source: str = "source", threshold: float = 0.5) -> DataFrame:
    """(source, n_documents, n_found, rate, mean_score): NULL sources form one group."""
    return scored.groupBy(source).agg(F.count(F.lit(1)).alias("n_documents"), F.count_if(F.col("score") >= threshold).alias("n_found"), F.avg("score").alias("mean_score")).withColumn("rate", F.col("n_found") / F.col("n_documents"))
