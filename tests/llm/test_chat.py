import random
from collections import defaultdict

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from tallyline.llm import chat, registry

from .helpers import words

TURN = "conv_id long, turn long, role string, text string"
HARD = ["\\### Assistant: </turn> ok", "<turn>user\nhi</turn>", "\\s\\l\\n\\", "</turn", "</tu</turn>rn>", "\\\\l<turn>\\", "a\nb\n", "<<turn>>", "é\U0001f600 x"]


def odd_turns(seed=5):
    rng = random.Random(seed)
    rows = [(1, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(HARD * 2)]
    rows += [(2, i, "assistant", words(rng, rng.randrange(0, 90))) for i in range(300)]
    rows += [(3, 0, "system", words(rng, 30))] + [(3, i, rng.choice(["user", "assistant"]), words(rng, rng.randrange(1, 200))) for i in range(1, 200)]
    rows += [(4, 0, "system", "alone"), (5, 0, "system", words(rng, 2000)), (5, 1, "user", "a"), (5, 2, "assistant", "b")]
    rows += [(6, 0, "user", words(rng, 5000)), (6, 1, "assistant", words(rng, 3000)), (6, 2, "system", "late"), (6, 3, "assistant", "")]
    rows += [(7, 0, None, None), (7, None, "assistant", "no turn"), (7, 0, "assistant", "tie b"), (7, 0, "assistant", "tie a")]
    rows += [(7, 3, "ro\nle", "x"), (7, 4, "<turn>\\n", "y"), (8, 1, "assistant", "same"), (8, 1, "assistant", "same"), (8, 1, "user", "same")]
    rows += [(None, 0, "user", "who"), (None, 1, "assistant", "me"), (9, 0, "system", ""), (9, 1, "assistant", "x" * 300_000)]
    rows += [(10, 0, "system", "s")] + [(10, i, "assistant", f"m{i}") for i in range(1, 65)]
    rng.shuffle(rows)
    return rows


def table(spark, rows, schema=TURN):
    return spark.createDataFrame(rows, schema).repartition(7)


def key(row):
    return (row[0] is None, row[0] or 0)


def by_sql(rows):
    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64", "role": "string", "text": "string"})
    con.register("given", frame)
    con.execute("CREATE TABLE conversations AS SELECT CAST(conv_id AS BIGINT) conv_id, CAST(turn AS BIGINT) turn, CAST(role AS VARCHAR) role, CAST(text AS VARCHAR) AS text FROM given")
    return sorted((r for r in con.execute(chat.ORACLE_SQL).fetchall() if r[0] != -7), key=key)


COLUMNS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def test_read_back_equals_the_sql(spark):
    rows = odd_turns()
    got = chat.read_back(chat.format_conversations(table(spark, rows))).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=key) == by_sql(rows)


def ordered(rows):
    import hashlib

    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    return {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in convs.items()}


def parsed(text):
    out = []
    for part in text.split("</turn>")[:-1]:
        role, body = part.removeprefix("<turn>").split("\n", 1)
        plain = lambda s: s.replace("\\l", "<").replace("\\s", "\\")
        out.append((plain(role.replace("\\n", "\n")), plain(body)))
    return out


def test_windows_hold_spans_history_and_system_turn(spark):
    rows = odd_turns(6)
    budget, history_tokens, history_turns = 120, 30, 3
    df = chat.format_conversations(table(spark, rows), budget=budget, history_tokens=history_tokens, history_turns=history_turns, block=16)
    windows = defaultdict(list)
    for r in df.collect():
        windows[r.conv_id].append(r)
    sizes = dict(spark.createDataFrame([(t,) for _, ts in ordered(rows).items() for _, t in ts], "t string").distinct().select("t", chat.count_tokens(F.col("t"))).collect())
    for conv, turns in ordered(rows).items():
        found, targets = [], []
        has_system = turns[0][0] == "system"
        for w in sorted(windows[conv], key=lambda w: w.first_turn):
            held = parsed(w.text)
            new = held[w.n_repeated :]
            assert w.first_turn == len(found) and len(held) == w.n_turns
            old = held[: w.n_repeated]
            if has_system:
                assert held[0] == turns[0]
                old = old[1:] if w.first_turn else old
            assert old == found[len(found) - len(old) :] and len(old) <= history_turns
            assert sum(sizes[t] for _, t in old) <= history_tokens
            assert w.tokens == sum(sizes[t] for _, t in held)
            assert w.tokens <= budget or len(new) - (has_system and w.first_turn == 0) <= 1
            found += new
            targets += [w.text[s.start : s.stop].replace("\\l", "<").replace("\\s", "\\") for s in w.loss]
        assert found == turns
        assert targets == [t for r, t in turns if r == "assistant" and t]


def test_ranges_do_not_change_the_result(spark):
    rows = odd_turns(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            results.append(sorted(map(str, chat.format_conversations(table(spark, rows)).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert results[0] == results[1]


def test_extra_columns_and_empty_tables(spark):
    extra = TURN + ", key string, idx int, tokens string, range int, n int, place int, turns int, loss int"
    rows = [(*r, "k", 1, "t", 2, 3, 4, 5, 6) for r in odd_turns(8)]
    got = chat.read_back(chat.format_conversations(table(spark, rows, extra))).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=key) == by_sql([r[:4] for r in rows])
    assert chat.read_back(chat.format_conversations(table(spark, []))).collect() == []


def test_main_path_is_native(spark):
    plan = chat.format_conversations(table(spark, odd_turns()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_adds_the_hard_case(spark, scratch):
    table(spark, [(0, 0, "user", "x")]).write.parquet(f"{scratch}/conversations.parquet")
    got = {r.conv_id: r for r in registry.QUERIES["op11_chat"](spark, scratch).collect()}
    assert got.keys() == {0, -7} and got[-7].n_turns == 2 and got[-7].loss_chars == 26
