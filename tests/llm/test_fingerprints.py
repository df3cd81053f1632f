import hashlib
import re
import struct

import xxhash

from tallyline.llm import fingerprints

from .helpers import CLASHING, doc, frame, odd_docs, with_extras


def xx(data, seed=42):
    return xxhash.xxh64(data, seed=seed).intdigest()


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def brute_sketch(text, scale=fingerprints.SCALE):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    hashes = [xx(w.encode()) for w in words]

    def chain(hs):
        seed = 42
        for h in hs:
            seed = xx(struct.pack("<Q", h), seed)
        return signed(seed)

    s = [chain(hashes[i:i + 5]) for i in range(len(hashes) - 4)] if len(hashes) >= 5 else [chain(hashes)] if hashes else []
    kept = sorted({h for h in s if h < -(1 << 63) + (1 << 64) // scale})
    return kept or ([min(s)] if s else [])


def text_of(sketch):
    return f"{fingerprints.SCALE}:" + "".join(f"{h & ((1 << 64) - 1):016X}" for h in sketch)


def like(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, got):
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: r[0])
    assert len(got) == len(rows)
    by_id = {g["doc_id"]: g for g in got}
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        g = by_id[i]
        assert g["n_chars"] == len(t)
        assert g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert g["fingerprint"] == text_of(brute_sketch(t))
        assert g["edited_fingerprint"] == text_of(brute_sketch(edited))
        assert g["near_edited"] == like(brute_sketch(t), brute_sketch(edited))
        assert g["near_next"] == like(brute_sketch(t), brute_sketch(nxt))


def unique(rows):
    return list({r[0]: r for r in rows if r[0] is not None}.values())


def test_equals_brute_force(spark):
    rows = unique(odd_docs())
    check(rows, fingerprints.fingerprint_documents(frame(spark, with_extras(rows), CLASHING), range_rows=7).collect())


def test_uneven_ids_meet_their_neighbours(spark):
    rows = [doc(i, f"text number {i} 🙂 of many") for i in [*range(40), -(1 << 62), 10**15, 10**15 + 1, 1 << 61]]
    check(rows, fingerprints.fingerprint_documents(frame(spark, rows), range_rows=3).collect())


def test_edges(spark):
    assert fingerprints.fingerprint_documents(frame(spark, [])).collect() == []
    (one,) = fingerprints.fingerprint_documents(frame(spark, [doc(5, "abcd")])).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1.0
    rows = [doc(1, "a b"), doc(1, "a b"), doc(1, "c"), (None, "x y", None, None, None), doc(2, None)]
    got = fingerprints.fingerprint_documents(frame(spark, rows)).collect()
    assert len(got) == 5
    assert len({g["fingerprint"] for g in got if g["doc_id"] == 1}) == 2
    assert {g["fingerprint"] for g in got if g["doc_id"] == 2} == {f"{fingerprints.SCALE}:"}


def test_containment_of_a_part(spark):
    whole = " ".join(f"word{i}" for i in range(4000))
    part = " ".join(f"word{i}" for i in range(1000, 1800))
    df = spark.createDataFrame([(whole, part)], "a string, b string")
    df = fingerprints.add_sketch(fingerprints.add_sketch(df, "a", "sa"), "b", "sb")
    r = df.select(fingerprints.containment(df["sb"], df["sa"]).alias("in"), fingerprints.containment(df["sa"], df["sb"]).alias("of")).first()
    assert r["in"] == 1.0 and abs(r["of"] - 0.2) < 0.06
