import duckdb
import random

import corpus_pipeline
from tallyline.llm import lines

from .helpers import CLASHING, DOC, doc, frame, odd_docs, with_extras


def corpus():
    rng = random.Random(3)
    w = [a + b for a in "bcdfg" for b in ("ala", "ene", "iti", "oro", "usu")]
    prose = lambda: " ".join(rng.choice(w) for _ in range(rng.randrange(3, 20)))
    rows = []
    for i in range(60):
        own = [prose() for _ in range(rng.randrange(1, 6))]
        if i % 2:
            own.insert(rng.randrange(len(own) + 1), "All rights reserved.")
        if i % 3 == 0:
            own.insert(rng.randrange(len(own) + 1), f"Posted  on 2024-0{i % 9 + 1}-1{i % 7} by user{i} in\t{rng.choice(w)} {rng.choice(w)} area")
        rows.append(doc(i, "\n".join(own)))
    copy = "\n".join(prose() for _ in range(4))
    rows += [doc(100 + i, copy) for i in range(40)]  # a copied document's lines stay
    rows += [doc(200, "All rights reserved."), doc(201, "\n\n \n"), doc(202, "x\r\nAll rights reserved.\n\ny")]
    rows += [doc(203, "same line here\n" * 300), doc(204, "long " * 20000)]
    return rows + odd_docs()[60:]


def digest(df):
    return sorted(map(str, ((r["doc_id"], r["text"] or "", r["n_lines"], r["n_dropped"]) for r in df.collect())))


def test_recurring_lines_go(spark):
    got = {r["doc_id"]: r for r in lines.dedup_lines(frame(spark, corpus()), min_docs=10).collect()}
    assert not any("rights reserved" in (r["text"] or "") or "Posted" in (r["text"] or "") for r in got.values())
    texts = {r[0]: r[1] for r in corpus()}
    for i in [*range(100, 140), 201, 203, 204]:
        assert got[i]["text"] == texts[i] and got[i]["n_dropped"] == 0
    assert (got[200]["text"], got[200]["n_lines"], got[200]["n_dropped"]) == ("", 1, 1)
    assert got[202]["text"] == "x\r\n\ny"


def test_equals_the_sql(spark):
    rows = [r for r in corpus() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    got = lines.dedup_lines(frame(spark, rows))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    import hashlib

    mine = {(r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in got.collect()}
    assert sum(r[2] for r in mine) > 20
    assert mine == set(con.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({lines.ORACLE_SQL})").fetchall())


def sql_kept(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    return set(con.execute(f"SELECT doc_id, n_dropped, kept_sha256 FROM ({lines.ORACLE_SQL})").fetchall())


def test_query_drops_what_copies_and_blank_lines_hid(spark):
    import hashlib

    copy = "\n".join([*own(600), "All rights reserved.", *own(601)])
    rows = [doc(i, "\n".join([*own(i), "", "Share this page.", "", "All rights reserved."])) for i in range(100)]
    rows += [doc(1000 + i, copy) for i in range(200)]
    got = lines.dedup_lines(frame(spark, rows)).collect()
    assert all(r["n_dropped"] == (2 if r["doc_id"] < 1000 else 1) for r in got) and len(got) == 300
    assert {(r["doc_id"], r["n_dropped"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in got} == sql_kept(rows)


def test_edges(spark):
    assert lines.dedup_lines(frame(spark, [])).collect() == []
    docs = frame(spark, with_extras(odd_docs()), CLASHING)
    out = lines.drop_boilerplate(docs)
    assert out.columns == [*docs.columns, "__n_lines", "__n_dropped"] and out.count() == len(odd_docs())
    a, b = (lines.dedup_lines(frame(spark, corpus(), DOC, n)) for n in (1, 5))
    assert digest(a) == digest(b)


def kept_lines(spark, rows):
    got = corpus_pipeline.line_dedup(spark, frame(spark, rows), None).collect()
    assert len(got) == len(rows)
    return {r["doc_id"]: r["text"] for r in got}


def own(i, n=3):
    rng = random.Random(i)
    return [" ".join(f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{chr(97 + i % 26)}{chr(97 + i // 26)}{rng.choice('xyz')}" for _ in range(8)) for _ in range(n)]


def test_pipeline_drops_a_line_of_copies_and_of_many_other_texts(spark):
    copy = "\n".join([*own(600), "All rights reserved.", *own(601)])
    rows = [doc(i, "\n".join([*own(i), "All rights reserved."])) for i in range(40)] + [doc(1000 + i, copy) for i in range(200)]
    got = kept_lines(spark, rows)
    assert all(got[i] == "\n".join(own(i)) for i in range(40))
    assert all(got[1000 + i] == "\n".join([*own(600), *own(601)]) for i in range(200))


def test_pipeline_drops_blocks_and_lines_between_blank_lines(spark):
    head, mid, foot = (["Home of the news", "Sport", "Log in here"], ["We use cookies.", "Read our terms.", "Accept all of them."], ["About us", "Contact", "Imprint"])
    rows = []
    for i in range(30):
        a, b, c, d = (own(25 * k + i, 2) for k in (0, 2, 4, 6))
        rows.append(doc(i, "\n".join([*head, *a, *mid, *b, "", "Share this page.", "", *c, *d, *foot])))
    near = own(500, 20)
    rows += [doc(100 + i, "\n".join([*near[:10], *own(300 + i, 1), *near[10:]])) for i in range(40)]  # near copies stay
    rows += [doc(200 + i, "This page is gone.") for i in range(40)]  # so do copies of one line
    got = kept_lines(spark, rows)
    for i in range(30):
        a, b, c, d = (own(25 * k + i, 2) for k in (0, 2, 4, 6))
        assert got[i] == "\n".join([*a, *b, "", "", *c, *d])
    assert all(got[r[0]] == r[1] for r in rows[30:])


def test_copies_of_every_page_do_not_hide_its_block(spark):
    rows = [doc(100 * i + k, "\n".join(["Menu", "Search", "Help", *own(i)])) for i in range(25) for k in range(22)]
    got = kept_lines(spark, rows)
    assert all(got[100 * i + k] == "\n".join(own(i)) for i in range(25) for k in range(22))
