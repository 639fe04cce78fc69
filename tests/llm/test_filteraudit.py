import itertools
import re

import pytest

from roadloom.llm import filteraudit

MANY = " ".join(f"word{i}" for i in range(220))
DOCS = [(1, "short text", "a"), (2, "short text", "a"), (3, MANY, "a"), (4, MANY, "b"), (5, MANY + " $", "b"), (6, "same " * 300, "b"),
        (7, MANY.upper(), "b"), (8, MANY.upper() + " &", None), (9, None, None), (10, "", "b"), (None, MANY, "a"), (3, MANY, "a"),
        (11, "Ä" * 50 + " ÖÜ", "a"), (12, "no break #", "a")]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 1), (4, 1, None), (5, 0, 1), (None, 1, 1), (10, 1, 1), (99, 1, 1)]


def mask(row, rows):
    doc_id, text, _ = row
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    smaller = doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in rows)
    return "".join(c for c, bad in zip("ABCDE", (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
                                                 any(c in "#$%&*|" for c in text), smaller)) if bad)


def brute_force(rows, labels):
    """Every order applied to every document, one filter after the other."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    for part in {s or "" for _, _, s in rows}:
        mine = [(r[0], mask(r, rows)) for r in rows if (r[2] or "") == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                fails = [x for x in mine if letter in x[1]]
                removed = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                out[part, order, step] = [len(left), len(removed), len(fails) - len(removed), sum(x[1] == letter for x in mine),
                                          sum(x[0] in good for x in removed), sum(x[0] in toxic for x in removed)]
    sums = {}
    for (part, order, step), v in out.items():
        sums[part, order[step - 1]] = sums.get((part, order[step - 1]), 0) + v[1]
    return {(p, o, s, *v, sums[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_equals_brute_force(spark):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in DOCS], "doc_id long, text string, source string, mask int, digest string, part int").repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filteraudit.audit(filteraudit.cells(filteraudit.document_masks(docs), labels)).collect()
    assert len(got) == 3 * 600
    assert {tuple(r) for r in got} == brute_force(DOCS, LABELS)


def test_other_numbers_of_filters(spark):
    counts = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 3, 2, 1, 1), ("p", 2, 4, 0, 0)], "part string, mask int, n long, good long, toxic long")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in filteraudit.audit(counts, "XY").collect()}
    assert got == {("XY", 1): (9, 2, 0, 2), ("XY", 2): (5, 4, 2, 10), ("YX", 1): (5, 6, 0, 10), ("YX", 2): (5, 0, 2, 2)}
    with pytest.raises(ValueError):
        filteraudit.audit(counts, "ABCDEFGH")


def test_long_text_is_read_whole(spark):
    docs = spark.createDataFrame([(1, "a b " * 2_000_000 + "$", "s"), (2, "c", "s")], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.mask) for r in filteraudit.document_masks(docs).collect()) == [(1, 2 + 8), (2, 1)]
