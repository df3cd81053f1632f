"""Small document tables for the operators' tests."""

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=DOC, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


def doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text))


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_docs(seed=7, n=60):
    """Random texts with nulls, empties, copies, near copies, a long text,
    repeated rows and texts without words."""
    rng = random.Random(seed)
    rows = [doc(i, words(rng, rng.randrange(1, 120)), rng.choice(["en", "de", None]), rng.choice(["a", "b", None])) for i in range(n)]
    base = words(rng, 100)
    for i in range(n, n + 12):
        w = base.split()
        for _ in range(i - n):
            w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
        rows.append(doc(i, " ".join(w)))
    rows += [doc(n + 20, base), doc(n + 21, base, source="b"), doc(n + 22, None, None, None), doc(n + 23, ""), doc(n + 24, " \t\n")]
    rows += [doc(n + 25, words(rng, 9000)), doc(n + 26, "é" * 3000), doc(n + 27, "one"), doc(n + 28, "one"), doc(n + 29, "A b C"), doc(n + 30, "a B c")]
    rows += [rows[3], rows[3], (None, "no id here at all", "en", "a", 17)]
    return rows


#: extra columns with names that operators use for their results
CLASHING = DOC + ", score double, size long, copies long, lang_pred string, component long, n_lines int, text_hash long, id long, length long"


def with_extras(rows):
    return [(*r, 0.5, 1, 2, "zz", 3, 4, 5, 6, 7) for r in rows]
