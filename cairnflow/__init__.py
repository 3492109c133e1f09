"""cairnflow: a Spark-first analytics engine for filings-shaped data.

Sub-packages: ``functions`` (column expressions), ``sources`` (readers and writers),
``operators`` (DataFrame to DataFrame), ``plans`` (named queries with their SQL),
``streaming`` (Structured Streaming). ``llm`` holds the operators for text corpora
and is imported by nothing else in the library.
"""
