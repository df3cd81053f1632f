import random
from collections import Counter

from tallyline.llm import audit

from .helpers import CLASHING, DOC, doc, odd_docs, with_extras, words

LABELS = "doc_id long, quality long, toxic long"


def fails_of_text(text):
    w = text.replace("\x0b", " ").replace("\x0c", " ").split()
    w = [x for x in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if x]
    return {
        f
        for f, bad in (
            ("A", len(w) < 100),
            ("B", 100 * len(set(w)) < 80 * len(w)),
            ("C", 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text)),
            ("D", any(c in "#$%&*|" for c in text)),
        )
        if bad
    }


def brute(rows, labels):
    """Every order run left to right over all documents."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, text, lang, *_ in rows:
        text = text or ""
        fails = fails_of_text(text)
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in rows):
            fails.add("E")
        docs.append((lang or "", fails, i in good, i in toxic))
    out = []
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley, part_rows = Counter(), []
        for order in audit.ORDERS:
            left = own
            for k, f in enumerate(order, 1):
                here = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                redundant = sum(f in d[1] for d in own) - len(here)
                unique = sum(d[1] == {f} for d in own)
                shapley[f] += len(here)
                part_rows.append((part, order, k, len(left), len(here), redundant, unique, sum(d[2] for d in here), sum(d[3] for d in here)))
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in part_rows]
    return sorted(out)


def corpus():
    rng = random.Random(13)
    rows = odd_docs(13, 40)
    long = " ".join(f"v{i}" for i in range(150))
    # copies whose smallest id comes in a later file, in other parts too
    rows += [doc(900 - i, long, lang=["en", "de", None][i % 3]) for i in range(30)]
    rows += [doc(200 + i, f"{words(rng, 120, 20)} {'# ABCD' * 9}") for i in range(5)]
    rows += [doc(300, "A b\x0bc\x0cd\re\tf  g\n"), doc(301, "é" * 9 + "A"), doc(302, "x" * 200_000)]
    rows += [(None, long, "en", "s", 1), (None, long, "", "s", 1), (871, long, "fr", "s", 1)]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 900, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (6, None, None)]
    return rows, [(i, q, None if t is None else int(t)) for i, q, t in labels]


def saved(spark, scratch, rows, schema=DOC, files=6):
    path = f"{scratch}/documents.parquet"
    for k in range(files):
        spark.createDataFrame(rows[k::files], schema).coalesce(1).write.mode("append").parquet(path)
    return path


def result(spark, path, labels, **options):
    got = audit.audit_documents(spark, path, spark.createDataFrame(labels, LABELS), **options)
    return sorted(tuple(r) for r in got.collect())


def test_equals_running_every_order(spark, scratch):
    rows, labels = corpus()
    assert result(spark, saved(spark, scratch, rows), labels, group_texts=4) == brute(rows, labels)


def test_batches_and_clashing_columns_change_nothing(spark, scratch):
    rows, labels = corpus()
    path = saved(spark, scratch, with_extras(rows), CLASHING, files=3)
    assert result(spark, path, labels, batches=1) == brute(rows, labels)


def test_empty_table(spark, scratch):
    assert result(spark, saved(spark, scratch, [], files=1), []) == []


def test_smaller_ids_retract_what_was_counted():
    held = {}
    first = audit.retract(held, [("t", 9, False, "en", 1, 1, 0, 2)])
    assert first == {("en", 1, 1, 0): 2}
    # the same id in another part is no copy of itself
    again = audit.retract(held, [("t", 9, False, "de", 1, 1, 0, 1), ("t", 12, False, "fr", 1, 0, 0, 1)])
    assert again == {("de", 1, 1, 0): 1, ("fr", 17, 0, 0): 1}
    smaller = audit.retract(held, [("t", 5, False, "es", 1, 0, 1, 1), ("t", None, False, "en", 1, 0, 0, 4), ("t", None, True, "en", 1, 0, 0, 3)])
    expected = {("es", 1, 0, 1): 1, ("en", 1, 0, 0): 4, ("en", 17, 0, 0): 3}
    expected |= {("en", 1, 1, 0): -2, ("en", 17, 1, 0): 2, ("de", 1, 1, 0): -1, ("de", 17, 1, 0): 1}
    assert smaller == expected
    assert held == {"t": [5, 1, {("es", 0, 1): 1}]}
