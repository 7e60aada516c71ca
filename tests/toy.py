"""A small collection with awkward corners, and a plain-Python index of it."""

from __future__ import annotations

from lexipost import schemas

LINE = "hello hello world I my name I \n information retrieval hi hello world"
PARSED = [
    ("0", "test_parse1", LINE),
    ("0", "test_parse2", LINE + " this is part B"),
]

MIXED = [
    ("10", "b.txt", "beta gamma alpha"),
    ("2", "a.txt", "alpha Alpha, alpha. alpha"),
    ("0!", "z", "gamma delta\u001cepsilon　alpha"),
    ("0", "empty", ""),
    ("0", "x", "alpha beta"),
    ("0", "blank", " \n\t "),
    ("2", "c.txt", "\n beta  zeta "),
    ("0!", "B", "Alpha beta alpha"),
    ("0!", "a", "alpha omega omega"),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.DOCUMENTS)


def plain_index(rows):
    """(paths, terms, postings) of the rows, built in memory."""
    paths, terms, postings = [], {}, []
    for block, name, text in sorted(rows, key=lambda row: (row[0].encode(), row[1].encode())):
        doc_id = len(paths)
        paths.append(f"{block}/{name}")
        for word in text.split():
            terms.setdefault(word, len(terms))
        postings += [(terms[word], doc_id) for word in set(text.split())]
    return paths, terms, sorted(postings)


def pairs(df):
    return sorted((row.term_id, row.doc_id) for row in df.select("term_id", "doc_id").collect())
