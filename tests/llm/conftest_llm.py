"""Rows that the tests of the operators share."""

#: Nulls, empty and blank texts, copies, a repeated row, rows without id, a very long text.
ODD = [
    (1, "one two  three four five six"), (2, None), (3, ""), (4, " \t\n"), (5, "one two three four five six"), (5, "one two three four five six"),
    (None, "one two three four five six"), (None, None), (7, "secret token=abcdefghijkl123 <|endoftext|> ÀÉ İ 日本"), (8, "word " * 30_000), (9, "word"),
]


def build(spark, rows):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use themselves."""
    df = spark.createDataFrame(
        [(*r, "en", "s", len(r[1] or "")) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars int"
    )
    return df.selectExpr(
        "*", "'x' as kept", "1 as size", "2 as code", "3 as `key`", "4 as node", "'y' as spans", "5 as found", "6 as ids", "0.5 as score", "'z' as shard", "1 as _scanned", "'u' as _scored", "2 as _masked", "3 as _gone", "4 as _text", "5 as _w1", "6 as _s", "7 as _k", "8 as _key", "9 as _size"
    )
