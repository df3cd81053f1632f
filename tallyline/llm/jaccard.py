"""Set similarity join of documents on word n-grams, by token-combination
prefixes.

A document is the set of its distinct n-word shingles. Two sets of Jaccard
similarity at least T share a token among their first ``n - ceil(T n) + 1``
in any fixed order of all tokens, and two tokens if both prefixes are longer
by one. The order here puts frequent tokens last, so that passages shared by
many documents stay out of the prefixes. Rare tokens of a prefix are indexed
singly; in small sets, whose combinations are few, frequent ones are indexed
by pairs over the longer prefix, in larger sets singly. Sizes near the limit
are indexed both ways, so that no pair falls between. Which tokens count as
frequent is counted over all documents, and only the order depends on it: any
order gives every link.

Then candidates are verified in two steps that lose no link: first every
document of an index entry against one document of the entry (its head),
which joins most copies at once; then the documents of a head that are
outside its largest component against all others of that head, as far as the
lengths, the places of the entries in the two sets, and the distances to the
head (Jaccard distance obeys the triangle inequality) allow. A pair is first bounded by its two prefixes: tokens up to
the smaller prefix end are all known, of the rest at most the shorter one's
can be shared. Only pairs within reach meet with their whole sets.
Documents of equal sets are one class throughout.

Shingles are compared by 62-bit hashes; two different shingles of one pair
of documents collide with a chance of about 1e-13.

Defined results: a null text, or one without words, has the empty set and
links with nothing; a text of fewer than n words is one shingle; a null id
is a document of its own without component; rows that repeat an id are
documents that share it, and so a component; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RE, byte_slices, encoded_words, release, stage, text_of, word_lists
from .components import connected_components

#: documents that must hold a token to make it frequent
FREQUENT = 32
#: one document in so many is looked at: all are
SAMPLE = 1
#: groups that tokens are counted in (2^8 at least: 3 bytes hold the rest of 32 bits)
PARTS = 1024
#: tokens that a task holds to count them together
HELD_TOKENS = 1 << 20
#: at most so many frequent tokens are kept and broadcast (8 bytes each)
MAX_FREQUENT = 1_000_000
#: bytes of text whose shingles are hashed at once (about 30 times that in arrays)
SET_BYTES = 1 << 20
#: sets up to this size index pairs of frequent tokens
PAIR_MAX = 40
#: this bit of a token says that it is frequent, and sorts it last
OFTEN = 1 << 62


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingle_sets(text: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes (62 bits) of every text, one after the
    other, and the offsets of each text's."""
    flat, off = word_lists(text, lower=True)
    words, codes = encoded_words(flat)
    if not words:
        return np.empty(0, np.uint64), np.zeros(len(text) + 1, np.int64)
    with np.errstate(over="ignore"):
        h = pd.util.hash_array(np.array(words, dtype=object), categorize=False)[codes]
        count = np.diff(off)
        row = np.repeat(np.arange(len(count)), count)
        room = off[row + 1] - np.arange(len(h))
        gram = np.zeros(len(h), np.uint64)
        for k in range(n):
            nxt = np.minimum(np.arange(len(h)) + k, len(h) - 1)
            gram = np.where(room > k, _mix(gram + h[nxt] + np.uint64(k + 1)), gram)
        keep = (room >= n) | ((count[row] < n) & (room == count[row]))
    gram, row = gram[keep] >> np.uint64(2), row[keep]
    order = np.lexsort((gram, row))
    gram, row = gram[order], row[order]
    first = np.ones(len(gram), bool)
    first[1:] = (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])
    gram, row = gram[first], row[first]
    return gram, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(count)))])


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-percent * n // 100) + 1


def _lists(values: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(values.view(np.int64)))


def _cut(values: np.ndarray, off: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` values of every row."""
    place = np.arange(len(values)) - np.repeat(off[:-1], np.diff(off))
    keep = place < np.repeat(n, np.diff(off))
    return values[keep], np.concatenate([[0], np.cumsum(np.minimum(n, np.diff(off)))])


def _sets_by_row(docs: DataFrame, shingle: int, percent: int, frequent: np.ndarray, whole: bool = False) -> DataFrame:
    """id, n, class (hash of the set), tokens: the prefix longer by one, in
    the order by hash with the frequent ones last; or the whole set."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        last = shared.value
        for b0 in batches:
            for b in byte_slices(b0, "text", SET_BYTES):
                gram, off = shingle_sets(b.column("text"), shingle)
                size = np.diff(off)
                with np.errstate(over="ignore"):
                    sums = [np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)]) for x in (_mix(gram), _mix(gram ^ np.uint64(0x5851F42D4C957F2D)))]
                    h1, h2 = (s[off[1:]] - s[off[:-1]] for s in sums)
                    name = _mix(_mix(h1 + size.astype(np.uint64)) ^ h2).view(np.int64)
                if not whole:
                    if len(last) and len(gram):
                        cut = gram >> np.uint64(30)
                        at = np.minimum(np.searchsorted(last, cut), len(last) - 1)
                        gram = gram | np.where(last[at] == cut, np.uint64(OFTEN), np.uint64(0))
                        gram = gram[np.lexsort((gram, np.repeat(np.arange(len(size)), size)))]
                    gram, off = _cut(gram, off, np.where(size > 0, prefix_length(size, percent) + 1, 0))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(size), pa.array(name), _lists(gram, off)], names=["id", "n", "class", "tokens"]
                )
                release()

    return docs.select("id", "text").mapInArrow(run, "id long, n long, class long, tokens array<long>")


def _counted(values: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, and how often each comes."""
    found, at = np.unique(values, return_inverse=True)
    return found, np.bincount(at, times, len(found)).astype(np.int64)


def _three_bytes(values: np.ndarray) -> bytes:
    """Numbers below 2^24, packed."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def _from_three_bytes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 3, 4), np.uint8)
    out[:, :3] = np.frombuffer(data, np.uint8).reshape(-1, 3)
    return out.view("<u4").reshape(-1)


def frequent_tokens(docs: DataFrame, shingle: int) -> np.ndarray:
    """Tokens that many documents hold, cut to their upper 32 bits (tokens of
    one cut count together, which only moves them in the order). All tokens of
    all documents are counted; they move as packed lists. A list's part is the
    lower bits of its tokens, so it holds the upper ones only, in 3 bytes each;
    what a task sees again within ``HELD_TOKENS`` tokens moves once."""

    def run(batches):
        def packed():
            t, n = _counted(np.concatenate(held), np.concatenate(times))
            part = t % PARTS
            order = np.argsort(part, kind="stable")
            t, n, part = t[order] // PARTS, n[order], part[order]
            ends = np.searchsorted(part, np.arange(PARTS + 1))
            rows = []
            for p in np.flatnonzero(np.diff(ends)):
                own, k = t[ends[p]:ends[p + 1]], n[ends[p]:ends[p + 1]]
                rows.append((int(p), _three_bytes(own[k == 1]), _three_bytes(own[k > 1]), k[k > 1].astype(np.uint32).tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["part", "once", "t", "n"])

        held: list[np.ndarray] = []
        times: list[np.ndarray] = []
        for b0 in batches:
            for b in byte_slices(b0, "text", SET_BYTES):
                t, n = np.unique((shingle_sets(b.column("text"), shingle)[0] >> np.uint64(30)).astype(np.uint32), return_counts=True)
                if len(t):
                    held.append(t)
                    times.append(n.astype(np.uint32))
                if sum(map(len, held)) >= HELD_TOKENS:
                    yield packed()
                    held, times = [], []
                release()
        if held:
            yield packed()

    def count(table):
        part = table.column("part")[0].as_py()
        once, t = (_from_three_bytes(b"".join(table.column(c).to_pylist())) for c in ("once", "t"))
        n = np.frombuffer(b"".join(table.column("n").to_pylist()), np.uint32)
        found, seen = _counted(np.concatenate([once, t]), np.concatenate([np.ones(len(once), np.uint32), n]))
        often = seen >= FREQUENT
        return pa.table({"t": found[often].astype(np.int64) * PARTS + part, "n": seen[often]})

    parts = docs.select("text").mapInArrow(run, "part long, once binary, t binary, n binary")
    seen = parts.groupBy("part").applyInArrow(count, "t long, n long")
    top = seen.orderBy(F.desc("n"), "t").limit(MAX_FREQUENT).select("t").toArrow().column("t").to_numpy()
    return np.sort(top.astype(np.uint64))


def _index(rows: DataFrame, percent: int) -> DataFrame:
    """key, class, rest, place: the index entries of every row (class, n,
    tokens); ``rest`` counts the set's tokens from the entry's (first) one on,
    ``place`` those before it."""
    low, high = PAIR_MAX * percent // 100, -(-PAIR_MAX * 100 // percent)

    def run(batches):
        for b in batches:
            tokens = b.column("tokens")
            flat = tokens.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            off = tokens.offsets.to_numpy().astype(np.int64)
            off = off - off[0]
            n = b.column("n").to_numpy()
            often = flat >= np.uint64(OFTEN)
            row = np.repeat(np.arange(len(n)), np.diff(off))
            inside = np.arange(len(flat)) - off[row] < prefix_length(n, percent)[row]
            paired, single = n <= high, n > low
            with np.errstate(over="ignore"):
                # rare tokens: of the longer prefix where pairs are used
                at = np.flatnonzero(np.where(often, inside & single[row], inside | paired[row]))
                keys, ids, rest = [_mix(flat[at])], [row[at]], [n[row[at]] - (at - off[row[at]])]
                for i in np.flatnonzero(paired):
                    place = np.flatnonzero(often[off[i]:off[i + 1]])
                    own = flat[off[i] + place]
                    if len(own) > 1:
                        a, c = np.triu_indices(len(own), 1)
                        keys.append(_mix(_mix(own[a]) + own[c]))
                        ids.append(np.full(len(a), i))
                        rest.append(n[i] - place[a])
            ids = np.concatenate(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), b.column("class").take(pa.array(ids)), pa.array(np.concatenate(rest)), pa.array(n[ids] - np.concatenate(rest))],
                names=["key", "class", "rest", "place"],
            )

    return rows.select("class", "n", "tokens").mapInArrow(run, "key long, class long, rest long, place long")


def _close(a: str, b: str, percent: int):
    """Whether sizes allow the similarity."""
    return (F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b))


def _reachable(n: str, other_n: str, rest: str, other_rest: str, percent: int):
    """Whether two sets can be similar whose first shared token has so many
    tokens from it on: they share no more than the fewer of these."""
    most = F.least(rest, other_rest)
    return F.lit(100) * most >= F.lit(percent) * (F.col(n) + F.col(other_n) - most)


def _unique(df: DataFrame, key: str, name: str) -> DataFrame:
    """One row per key; the wide rows are shuffled only if keys repeat."""
    df = stage(df, name)
    n, kinds = df.agg(F.count(F.lit(1)), F.countDistinct(key)).first()
    return df if n == kinds else stage(df.dropDuplicates([key]), name)


def _bounded(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """a, b, common (at most), near (whether the pair may link), from the two
    prefixes. Tokens are cut to 31 bits, which keeps their order and can only
    raise the bound."""
    short = prefixes.select("class", "n", F.transform("tokens", lambda t: F.shiftright(t, 32).cast("int")).alias("t"))
    x = short.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("t").alias("ta"))
    y = short.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("t").alias("tb"))
    both = pairs.join(x, "a").join(y, "b")

    def end(n, t):
        return F.when(F.col(n) <= F.size(t), F.lit((1 << 31) - 1)).otherwise(F.element_at(t, -1))

    both = both.withColumn("_end", F.least(end("na", "ta"), end("nb", "tb")))
    # below the end both are known; at the end a cut token may be another
    both = both.withColumn("_a", F.filter("ta", lambda t: t < F.col("_end"))).withColumn("_b", F.filter("tb", lambda t: t < F.col("_end")))
    same = F.size(F.array_intersect("_a", "_b")) + F.size("_a") - F.size(F.array_distinct("_a"))
    common = same + F.least(F.col("na") - F.size("_a"), F.col("nb") - F.size("_b"))
    both = both.select("a", "b", "na", "nb", F.least(common, "na", "nb").cast("long").alias("common"))
    return both.withColumn("near", F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("common")))


def _tested(pairs: DataFrame, prefixes: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """a, b, linked, and bounds low and high of their distance."""
    bound = stage(_bounded(pairs, prefixes, percent), "jaccard-bounds")
    near = bound.where("near").select("a", "b")
    wanted = near.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    wanted = stage(prefixes.select("class", "id").join(wanted, "class", "left_semi").select("id").distinct(), "jaccard-wanted")
    sets = _sets_by_row(texts.join(wanted, "id", "left_semi"), shingle, percent, np.empty(0, np.uint64), whole=True)
    sets = _unique(sets.select("class", "tokens"), "class", "jaccard-sets")
    left = sets.select(F.col("class").alias("b"), F.col("tokens").alias("tb"))
    right = sets.select(F.col("class").alias("a"), F.col("tokens").alias("ta"))
    exact = near.join(left, "b").join(right, "a")
    exact = exact.select("a", "b", F.size(F.array_intersect("ta", "tb")).cast("long").alias("common"), (F.size("ta") + F.size("tb")).cast("long").alias("total"))
    exact = exact.withColumn("total", F.col("total") - F.col("common"))
    away = 1 - F.col("common") / F.col("total")
    linked = F.lit(100) * F.col("common") >= F.lit(percent) * F.col("total")
    exact = exact.select("a", "b", linked.alias("linked"), away.alias("low"), away.alias("high"))
    least = 1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))
    far = bound.where("NOT near").select("a", "b", F.lit(False).alias("linked"), least.alias("low"), F.lit(1.0).alias("high"))
    return stage(exact.unionByName(far), "jaccard-tested")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, percent: int = 85) -> DataFrame:
    """id, n (set size) and component (smallest id reachable by links) of
    every row of ``docs``."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    frequent = frequent_tokens(texts, shingle)
    rows = stage(_sets_by_row(texts, shingle, percent, frequent), "jaccard-prefixes")
    full = rows.where("n > 0 AND id IS NOT NULL")
    classes = stage(full.groupBy("class").agg(F.min("id").alias("id"), F.first("n").alias("n")), "jaccard-classes")

    entries = _index(full, percent)
    # the head has the fewest tokens before the entry: of copies with edits of
    # their own, whose new tokens come first, one with few edits, which most are near to
    least = F.min(F.struct("place", "class")).alias("m")
    heads = entries.groupBy("key").agg(least, F.min("class").alias("a"), F.max("class").alias("z")).where("a <> z").select("key", F.col("m.class").alias("head"))
    entries = entries.drop("place")
    # of a pair under the head of its first shared entry, ``rest`` is at least
    # what follows that entry
    members = entries.join(heads, "key").groupBy("head", "class").agg(F.max("rest").alias("rest"))
    sizes = classes.select("class", "n")
    members = members.join(sizes, "class").join(sizes.select(F.col("class").alias("head"), F.col("n").alias("head_n")), "head")
    members = stage(members, "jaccard-members")

    # one prefix per class in some entry
    used = members.select("class").distinct().join(classes.select("class", "id"), "class")
    prefixes = _unique(full.join(stage(used, "jaccard-used"), ["class", "id"], "left_semi"), "class", "jaccard-used-prefixes")
    of_head = members.where("class = head").select("head", F.col("rest").alias("head_rest"))
    star = members.where("class <> head").join(of_head, "head").where(_close("n", "head_n", percent))
    star = star.where(_reachable("n", "head_n", "rest", "head_rest", percent)).select(F.col("head").alias("a"), F.col("class").alias("b"))
    tested = _tested(star, prefixes, texts, shingle, percent)
    links = tested.where("linked").select("a", "b")
    comp = stage(connected_components(links), "jaccard-components")

    # what the stars left open: under each head, those outside its largest
    # component against all others
    near = tested.select(F.col("a").alias("head"), F.col("b").alias("class"), "low", "high")
    own = members.join(comp, members["class"] == comp["node"], "left").select("head", "class", "n", "rest", F.coalesce("component", "class").alias("c"))
    many = own.groupBy("head", "c").agg(F.count(F.lit(1)).alias("k")).groupBy("head").agg(F.max(F.struct("k", "c")).alias("m"), F.count(F.lit(1)).alias("kinds"))
    many = many.where("kinds > 1").select("head", F.col("m.c").alias("main"))
    own = own.join(many, "head").join(near, ["head", "class"], "left").where("class <> head")
    # one out of its head's reach was not tested against it
    own = stage(own.fillna(0.0, ["low"]).fillna(1.0, ["high"]), "jaccard-open")
    x = own.where("c <> main").select("head", *[F.col(k).alias(f"x_{k}") for k in ("class", "n", "rest", "c", "low", "high")])
    y = own.select("head", "main", *[F.col(k).alias(f"y_{k}") for k in ("class", "n", "rest", "c", "low", "high")])
    reach = F.lit(1 - percent / 100 + 1e-9)
    rest = x.join(y, "head").where("x_c <> y_c AND (y_c = main OR x_class < y_class)").where(_close("x_n", "y_n", percent))
    rest = rest.where(_reachable("x_n", "y_n", "x_rest", "y_rest", percent))
    rest = rest.where((F.col("x_low") <= F.col("y_high") + reach) & (F.col("y_low") <= F.col("x_high") + reach))
    rest = rest.select(F.least("x_class", "y_class").alias("a"), F.greatest("x_class", "y_class").alias("b")).distinct()
    rest = stage(rest.join(tested.select("a", "b"), ["a", "b"], "left_anti"), "jaccard-rest")
    more = _tested(rest, prefixes, texts, shingle, percent).where("linked").select("a", "b")

    # classes of one id belong together too
    shared = full.select("id", "class").distinct()
    per_id = shared.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("z")).where("a <> z")
    same_id = shared.join(per_id, "id").where("a <> class").select("a", F.col("class").alias("b"))
    comp = stage(connected_components(links.unionByName(more).unionByName(same_id)), "jaccard-components")
    named = classes.join(comp, classes["class"] == comp["node"], "left").select("class", "id", F.coalesce("component", "class").alias("c"))
    named = stage(named, "jaccard-named")
    per_class = named.join(named.groupBy("c").agg(F.min("id").alias("component")), "c").select("class", "component")
    out = rows.select("id", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("class")).alias("class"))
    return out.join(per_class, "class", "left").select("id", "n", F.coalesce("component", "id").alias("component"))


def one_per_group(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` but for those whose group has a smaller doc_id;
    of rows that share an id, the one with the smallest text hash stays.
    Rows without words, or without an id, stay."""
    found = stage(similar_components(docs, "doc_id", "text", shingle, percent).where("n > 0 AND id IS NOT NULL"), "jaccard-groups")
    per_id = found.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.first("component").alias("component"))
    per_id = per_id.where("rows > 1 OR component <> id").select(F.col("id").alias("__id"), (F.col("component") != F.col("id")).alias("__gone"))
    wordy = F.coalesce(F.col("text").cast("string").rlike(WORD_RE), F.lit(False))
    both = docs.join(stage(per_id, "jaccard-removed"), (F.col("doc_id").cast("long") == F.col("__id")) & wordy, "left")
    plain = both.where("__id IS NULL")
    # ids of several rows, in groups that they lead
    again = both.where("NOT __gone").withColumn("__nr", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64(text_of()))))
    return plain.select(*docs.columns).unionByName(again.where("__nr = 1").select(*docs.columns))
