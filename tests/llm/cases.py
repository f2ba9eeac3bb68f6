"""Small tables and brute-force helpers shared by the operator tests."""

from __future__ import annotations

import re
from collections import defaultdict

WORD = re.compile(r"[^ \t-\r]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, n=5):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    if len(w) < n:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def groups(nodes, links):
    """node -> smallest node reachable."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    label = {}
    for start in sorted(nodes):
        if start in label:
            continue
        stack, label[start] = [start], start
        while stack:
            for other in near[stack.pop()]:
                if other not in label:
                    label[other] = start
                    stack.append(other)
    return label


def numbered(prefix, n):
    return " ".join(f"{prefix}{i}" for i in range(n))


LONG = numbered("long", 30_000)

# Nulls, blanks, very long texts, ties, repeated rows.
EDGE_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (5, "One"),
    (6, "a b c d"),
    (7, "a b c d e"),
    (8, LONG),
    (9, LONG + " tail"),
    (10, "same words here and there\nsame words here and there\nsame words here and there"),
    (10, "same words here and there\nsame words here and there\nsame words here and there"),
    (11, "é è   ñ 漢字 \U0001f600 é"),
    (None, "a b c d e"),
    (None, None),
]


def edge_docs(spark, empty=False):
    """The edge texts with columns whose names an operator might use itself."""
    rows = [] if empty else [(i, t, "n", 1, True, "x") for i, t in EDGE_TEXTS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, token string, n int, kept boolean, component string")


def table(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)
