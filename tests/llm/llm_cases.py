"""Rows that every text operator must take: nulls, empty and long texts, repeated rows, clashing columns."""

from __future__ import annotations

LONG = "alpha beta " * 30_000 + "x" * 50_000

TEXTS = [
    (1, "One short text, with a few words.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, "   \n\t ", "de", "b"),
    (5, LONG, "en", "a"),
    (6, "One short text, with a few words.", "en", "a"),
    (6, "One short text, with a few words.", "en", "a"),
    (None, "no id here but a text all the same", "en", None),
    (None, None, None, "c"),
]
#: Extra columns take names that operators use themselves.
COLUMNS = "doc_id long, text string, lang string, source string"
CLASHING = ["size", "target", "row", "fp", "key", "score", "kept", "n_tokens", "mix", "label", "id", "__row"]


def odd_rows(spark):
    df = spark.createDataFrame(TEXTS, COLUMNS)
    return df.selectExpr("*", *[f"'z' as `{name}`" for name in CLASHING])


def no_rows(spark):
    return spark.createDataFrame([], COLUMNS)


def components(nodes, links):
    """Union-find, the plain way: node -> smallest node reached."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}
