"""The filter audit against a plain walk through every order."""

from __future__ import annotations

import collections
import itertools

import numpy as np
import pytest

from marketmill.llm import filter_audit

COLUMNS = "doc_id long, text string, lang string, failed int, part string, n long, good string"
WORDS = [f"word{i}" for i in range(150)]
TEXTS = [
    (1, " ".join(WORDS), "en"), (2, " ".join(WORDS), "en"), (3, " ".join(WORDS) + " $", "en"),
    (4, None, "en"), (5, "", None), (6, "", ""), (7, " \t\n\x0b\x0c\r", "de"),
    (8, "a " * 500, "de"), (9, "SHOUTED " * 3, "de"), (10, "É" * 20 + "A B C", "de"),
    (11, "ABC " + " ".join(WORDS), "fr"), (12, "tag #here " + " ".join(WORDS * 2), None),
    (13, " ".join(WORDS).upper(), "en"), (14, "x" * 3_000_000, "fr"), (15, "x" * 3_000_000, "fr"),
    (16, " ".join(f"w{i % 90}" for i in range(100)), "en"), (17, " ".join(f"w{i % 80}" for i in range(100)), "en"),
    (18, "A" + "b" * 9, "en"), (19, "AB" + "b" * 9, "en"), (None, "", "en"), (None, "alone", "en"),
    (20, "one id", "es"), (20, "one id", "es"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, 0, 1), (8, 1, None), (9, None, 1), (99, 1, 1), (None, 1, 1), (20, 1, 1)]


def failures(rows):
    ids = collections.defaultdict(list)
    for id_, text, _ in rows:
        ids[text or ""].append(id_)
    for id_, text, lang in rows:
        text = text or ""
        words = text.encode().split()
        known = [x for x in ids[text] if x is not None]
        failed = "".join(
            name
            for name, fails in (
                ("A", len(words) < 100),
                ("B", 100 * len(set(words)) < 80 * len(words)),
                ("C", 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text)),
                ("D", any(c in "#$%&*|" for c in text)),
                ("E", bool(known) and (id_ is None or id_ > min(known))),
            )
            if fails
        )
        yield id_, lang or "", failed


def walked(rows, labels):
    """part, order, step -> counts, by going through the filters of each order."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    judged = list(failures(rows))
    out, shapley = {}, collections.Counter()
    for part in {p for _, p, _ in judged}:
        own = [(i, f) for i, p, f in judged if p == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                failing = sum(name in f for _, f in own)
                shapley[part, name] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), failing - len(gone), sum(f == name for _, f in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
    return {key: [*x, shapley[key[0], key[1][key[2] - 1]]] for key, x in out.items()}


def test_audit(spark):
    docs = spark.createDataFrame([(i, t, p, 7, "x", 1, "y") for i, t, p in TEXTS], COLUMNS)
    labels = spark.createDataFrame([(*x, "e") for x in LABELS], "doc_id long, quality int, toxic int, part string")
    found = filter_audit.audit(docs.repartition(4), labels).collect()
    got = {(r[0], r[1], r[2]): list(r[3:]) for r in found}
    assert len(got) == len(found) == 600 * len({p or "" for _, _, p in TEXTS})
    assert got == walked(TEXTS, LABELS)
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert filter_audit.audit(docs, labels.limit(0)).filter("good_lost + toxic_lost > 0").count() == 0


def test_steps_are_the_least_sums():
    rng = np.random.default_rng(0)
    masks = rng.random((40, 6)) < 0.3
    orders = [rng.permutation(6).tolist() for _ in range(30)]
    steps, _ = filter_audit.removal_steps(masks, orders)
    for o, order in enumerate(orders):
        for m, mask in enumerate(masks):
            first = next((s for s, f in enumerate(order, 1) if mask[f]), 7)
            assert steps[o, m] == first


def test_given_orders_of_other_filters(spark):
    rows = spark.createDataFrame([("p", 1), ("p", 3), ("p", 0)], "part string, failed int")
    found = filter_audit.interactions(rows, ["X", "Y"], orders=["YX"]).orderBy("step").collect()
    assert [tuple(r) for r in found] == [("p", "YX", 1, 2, 1, 0, 0, 1), ("p", "YX", 2, 1, 1, 1, 1, 1)]
    with pytest.raises(ValueError):
        filter_audit.interactions(rows, ["X", "Y"], orders=["YY"])
    with pytest.raises(ValueError):
        filter_audit.interactions(rows, list("ABCDEFGH"))


def test_slices_do_not_change_the_words(monkeypatch):
    text = ("één twee\tdrie  drie\x0bvier " * 50).encode()
    whole = filter_audit.word_counts(text)
    monkeypatch.setattr(filter_audit, "SLICE", 7)
    assert filter_audit.word_counts(text) == whole == (250, 4)
