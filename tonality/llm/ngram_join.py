"""N-gram Jaccard self-join by multiple-global-order filtering.

A document is its set of distinct word n-grams (64-bit hashes). Two documents link
when 100 * intersection >= PERCENT * union. Linked documents of size n share
a token among the first p = n - ceil(PERCENT n / 100) + 1 tokens of each under *any*
global order of the tokens. So:

1. The global orders put frequent tokens last, each order by a hash of its own among the others.
   Frequent are those that ``SEEN`` documents hold, counted over all documents (44 bits of their
   hashes, in packed sorted runs) and kept as a filter of bounded size; any fixed rule is a valid
   order, so what else passes the filter costs no link. Lines and passages that many documents
   share then enter the prefix of those documents only that consist of them.
2. Equal sets collapse to the smallest doc_id; only one row per set goes on. The prefixes under the
   first order give postings; tokens held once drop out by a filter.
3. Each posting has a centre, the member with the fewest rare prefix tokens. First all members close
   enough in length and position to a centre are compared with it, in one round.
4. Then pairs of a posting in different components. Members that link with the centre c are one component already.
   A member y known not to link with c can link with one that does only if y's similarity to c is at least
   2 PERCENT - 100 (distances obey the triangle inequality): y is far, or else close. If a close y links with any
   member x known to c, they share more than half of what sets x apart from c, corrected by their lengths. So such pairs
   come from a join on these differences, x's new tokens first, not from all members of a large
   group. Pairs of far or unknown members with others come from the posting.
5. Candidates also share a prefix token under both further orders. They are verified on whole sets, grouped by one
   document in parts of at most ``GROUP`` partners, so one with thousands of near copies is spread over tasks.

Sets are derived from whole texts; texts that need verification are read again through a filter of
doc_ids of bounded size, which may let others through but loses none. They travel compressed, a
fraction of the size of their sets of 64-bit hashes, which are made where they are compared.

Defined results: null or empty texts have an empty set and link to nothing; a text
of fewer than ``n`` words is one n-gram; rows that share a doc_id are one node;
a row with null doc_id gets its n_shingles and a null component; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import written
from tonality.llm.components import connected_components
from tonality.llm.rolling import bit_filter, passes
from tonality.llm.substring_dedup import BYTES_A_WORD, from_planes, planes

N = 4
PERCENT = 85
SEEN = 24
COUNTED_BITS = 44
RUN_TOKENS = 1 << 19
BUCKET_TOKENS = 1 << 19
GROUP = 256
SALTS = (0x5851F42D4C957F2D, 0x14057B7EF767814F)
ROW = "_row_key"


def mix64(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


# Byte values: separators become 0, A-Z their lower-case letters.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[[9, 10, 11, 12, 13, 32]] = 0
FOLD[65:91] += 32
BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64))
POWERS = np.cumprod(np.full(1 << 10, 0x9E3779B97F4A7C15, np.uint64))


def word_codes(text: str) -> np.ndarray:
    """uint64 hash of every word of the text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    data = FOLD[raw]
    inside = (data != 0) | (raw == 0)
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    first, after = edge[::2], edge[1::2]
    if not len(first):
        return np.zeros(0, np.uint64)
    # Each byte's place in its word; bytes before the first word do not count.
    data, inside, after, first = data[first[0]:], inside[first[0]:], after - first[0], first - first[0]
    place = np.arange(len(data)) - np.repeat(first, np.diff(np.append(first, len(data))))
    with np.errstate(over="ignore"):
        term = BYTE_CODES[data] * POWERS[place & 1023] + (place >> 10).astype(np.uint64) * inside
        term[~inside] = 0
        return mix64(np.add.reduceat(term, first) + (after - first).astype(np.uint64))


def shingle_set(text: str | None, n: int = N) -> np.ndarray:
    """Sorted distinct uint64 hashes of the text's word n-grams."""
    codes = word_codes(text) if text else np.zeros(0, np.uint64)
    if not len(codes):
        return codes
    n = min(n, len(codes))
    h = np.full(len(codes) - n + 1, n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + codes[k: len(codes) - n + 1 + k]
            h ^= h >> np.uint64(32)
    return np.unique(mix64(h))


def shared(s: np.ndarray, c: np.ndarray) -> int:
    """How many tokens two sorted sets share."""
    if not len(s) or not len(c):
        return 0
    at = np.searchsorted(c, s)
    return int(np.count_nonzero(c[np.minimum(at, len(c) - 1)] == s))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n + 1 + (-percent * n // 100)


def enough(shared: Column, a: Column, b: Column, percent: int = PERCENT) -> Column:
    """shared / (a + b - shared) >= percent / 100, in whole numbers."""
    return shared * (100 + percent) >= (a + b) * percent


def prefixes(s: np.ndarray, frequent: np.ndarray, percent: int) -> list[np.ndarray]:
    """The set's prefix under each order: rare tokens by hash, then frequent ones by hash."""
    p = prefix_length(len(s), percent)
    often = passes(frequent, s)
    out = []
    for salt in (0, *SALTS):
        held = []
        for part in (s[~often], s[often]):
            want = p - sum(map(len, held))
            if want > 0 and len(part):
                key = part if not salt else mix64(part ^ np.uint64(salt))
                held.append(np.partition(key, want - 1)[:want] if want < len(part) else key)
        out.append(np.concatenate([np.sort(h) for h in held]))
    return out


def _token_runs(n: int, buckets: int, seen: int):
    """(bucket, tokens, counts): the tokens of about RUN_TOKENS, sorted and packed as differences, for
    each of ``buckets`` equal ranges of ``COUNTED_BITS`` of their hashes."""
    def packed(sets: list[np.ndarray]) -> pd.DataFrame:
        token, count = np.unique(np.concatenate(sets) & np.uint64((1 << COUNTED_BITS) - 1), return_counts=True)
        first = np.arange(buckets, dtype=np.uint64) * np.uint64(-(-(1 << COUNTED_BITS) // buckets))
        cut = [*np.searchsorted(token, first).tolist(), len(token)]
        count = np.minimum(count, seen).astype(np.uint32)
        return pd.DataFrame([(k, planes(np.diff(token[x:y], prepend=np.uint64(0))), count[x:y].tobytes())
                             for k, (x, y) in enumerate(zip(cut, cut[1:])) if y > x], columns=["bucket", "tokens", "counts"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for b in batches:
            for text in b["text"]:
                held.append(shingle_set(text, n))
                size += len(held[-1])
                if size >= RUN_TOKENS:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)
    return run


def _counted(seen: int):
    """The tokens of a bucket that reach ``seen``."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        token = np.concatenate([np.cumsum(from_planes(x, np.uint64), dtype=np.uint64) for x in group["tokens"]])
        count = np.frombuffer(b"".join(group["counts"]), np.uint32)
        order = np.argsort(token, kind="stable")  # runs are sorted already
        token, count = token[order], count[order]
        start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        often = np.add.reduceat(count, start, dtype=np.uint64) >= seen
        return pd.DataFrame({"token": token[start[often]].view(np.int64)})
    return run


def frequent_tokens(docs: DataFrame, n: int = N, seen: int = SEEN) -> np.ndarray:
    """A filter of the tokens that ``seen`` documents hold, counted over all of them."""
    texts = docs.filter("text IS NOT NULL").select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // (BYTES_A_WORD * BUCKET_TOKENS)))
    runs = texts.mapInPandas(_token_runs(n, buckets, seen), "bucket long, tokens binary, counts binary")
    often = runs.groupBy("bucket").applyInPandas(_counted(seen), "token long")
    return bit_filter(written(often, "frequent-tokens"), "token")[1]


def _signatures(n: int, percent: int, frequent):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        none = np.zeros(0, np.int64)
        for b in batches:
            out = []
            for text in b["text"]:
                s = shingle_set(text, n)
                if not len(s):
                    out.append((0, 0, 0, none, none.astype(np.int32), none.astype(np.int32)))
                    continue
                with np.errstate(over="ignore"):
                    f1 = int((s * np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64).astype(np.int64))
                f2 = int(np.bitwise_xor.reduce(mix64(s)).astype(np.int64))
                top, *further = prefixes(s, frequent.value, percent)
                # The further prefixes only rule pairs out; half of each hash is enough.
                out.append((len(s), f1, f2, top.view(np.int64), *[(t >> np.uint64(32)).astype(np.uint32).view(np.int32) for t in further]))
            sig = pd.DataFrame(out, columns=["n_shingles", "f1", "f2", "top", "t1", "t2"])
            sig.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield sig
    return run


def _rows_where(filter_of, wanted: bool):
    """The rows whose hash ``h`` passes the filter, or those whose does not, without ``h``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = passes(filter_of.value, b.column("h").to_numpy().view(np.uint64))
            yield b.filter(pa.array(held if wanted else ~held)).drop_columns(["h"])
    return run


def filtered(rows: DataFrame, key: list[str], filter_of, wanted: bool = True) -> DataFrame:
    """``rows`` whose ``key`` passes a filter of its xxhash64 (or does not): a narrow step before a join."""
    keyed = rows.withColumn("h", F.xxhash64(*key))
    return keyed.mapInArrow(_rows_where(filter_of, wanted), rows.schema)


def _postings(filter_of, frequent):
    """(id, n, pos, token, rare, own) of the prefix tokens that pass; own: how many of the prefix do not; rare: how
    many are not frequent."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sizes = b["top"].map(len).to_numpy()
            token = np.concatenate([*b["top"], np.zeros(0, np.int64)]).astype(np.int64)
            of = np.repeat(np.arange(len(b)), sizes)
            pos = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            kept = passes(filter_of.value, token.view(np.uint64))
            own = sizes - np.bincount(of[kept], minlength=len(b))
            rare = sizes - np.bincount(of[passes(frequent.value, token.view(np.uint64))], minlength=len(b))
            of = of[kept]
            yield pd.DataFrame({"id": b["id"].to_numpy()[of], "n": b["n"].to_numpy()[of], "pos": pos[kept], "token": token[kept],
                                "rare": rare[of], "own": own[of]})
    return run


def difference(s: np.ndarray, c: np.ndarray, percent: int) -> tuple[bool, np.ndarray, int]:
    """Whether set ``s`` links with its centre ``c``, the tokens that only one of them has (those of ``s`` first), and a
    number m. A set that links with ``s`` but not with ``c`` has one of the first m of these in its own difference from
    ``c``. If ``s`` does not link and is too far from ``c`` to link with any set that does, there are no tokens."""
    new, gone = np.setdiff1d(s, c, assume_unique=True), np.setdiff1d(c, s, assume_unique=True)
    d, both = len(new) + len(gone), len(s) + len(c)
    tokens = np.concatenate((new, gone)).view(np.int64)
    shared = ((100 + percent) * d + (100 - percent) * (len(c) - len(s))) // (2 * (100 + percent)) + 1
    most = max(0, d - shared + 1)
    if 100 * (both - d) >= percent * (both + d):
        return True, tokens[:most], most
    if 100 * (both - d) >= (2 * percent - 100) * (both + d):
        return False, tokens, most
    return False, tokens[:0], 0


def _met(n: int, percent: int):
    """(a, b, linked, known, tokens, most): every member compared with its centre ``a``, in the order of ``_linked``;
    not known if the centre's doc_id has several sets."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        group, centres = None, []
        for batch in batches:
            out = []
            for a, part, b, packed in zip(batch["a"].tolist(), batch["part"].tolist(), batch["id"].tolist(), batch["packed"]):
                if (a, part) != group:
                    group, centres = (a, part), []
                s = shingle_set(unpack(packed).decode("utf-8", "surrogatepass"), n)
                if b == a:
                    centres.append(s)
                    continue
                met = [difference(s, c, percent) for c in centres]
                out.append((a, b, any(m[0] for m in met), len(met) == 1, *(met[0][1:] if len(met) == 1 else ([], 0))))
            yield pd.DataFrame(out, columns=["a", "b", "linked", "known", "tokens", "most"])
    return run


def _linked(n: int, percent: int):
    """The members of every (a, part) that link with its ``a``, by whole sets. Rows come sorted by
    group, those of its ``a`` first, so a task holds one group's centres and streams the rest."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        group, centres = None, []
        for batch in batches:
            out = []
            for a, part, b, packed in zip(batch["a"].tolist(), batch["part"].tolist(), batch["id"].tolist(), batch["packed"]):
                if (a, part) != group:
                    group, centres = (a, part), []
                s = shingle_set(unpack(packed).decode("utf-8", "surrogatepass"), n)
                if b == a:
                    centres.append(s)
                elif any(shared(s, c) * (100 + percent) >= (len(s) + len(c)) * percent for c in centres):
                    out.append((a, b))
            yield pd.DataFrame(out, columns=["u", "v"], dtype="int64")
    return run


class _Join:
    """The rounds of one self-join; all frames below are on shared storage."""

    def __init__(self, docs: DataFrame, signed: DataFrame, n: int, percent: int, group: int):
        self.docs, self.signed, self.n, self.percent, self.group = docs, signed, n, percent, group
        self.links: DataFrame | None = None

    def texts_of(self, ids: DataFrame) -> DataFrame:
        """(id, packed text) for the wanted ids, and for a few others that pass the filter."""
        wanted = self.docs.sparkSession.sparkContext.broadcast(bit_filter(ids.select(F.xxhash64("id").alias("h")), "h")[1])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            pack = zstandard.ZstdCompressor().compress
            for b in batches:
                b = b[passes(wanted.value, b["h"].to_numpy().view(np.uint64))]
                yield pd.DataFrame({"id": b["doc_id"].to_numpy(), "packed": pd.Series(
                    [pack(t.encode("utf-8", "surrogatepass")) for t in b["text"]], dtype=object)})

        some = self.docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
        return some.select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInPandas(run, "id long, packed binary")

    def ordered(self, pairs: DataFrame, name: str) -> DataFrame:
        """(a, part, id, packed text) of the pairs (a, b), a's own text first in each part."""
        parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / self.group).alias("parts"))
        dealt = pairs.join(parts, "a").select("a", F.col("b").alias("id"), F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
        centres = parts.select("a", F.col("a").alias("id"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        need = written(dealt.unionByName(centres), f"{name}-need")
        ids = written(need.select("id").distinct(), f"{name}-ids")
        texts = self.texts_of(ids).join(need, "id")
        return texts.select("a", "part", "id", "packed").repartition("a", "part").sortWithinPartitions(
            "a", "part", F.col("id") != F.col("a"))

    def add(self, links: DataFrame) -> None:
        self.links = links if self.links is None else self.links.union(links)

    def verify(self, pairs: DataFrame, name: str) -> None:
        """Adds the (a, b) of ``pairs`` that link: further orders first, then whole sets."""
        pairs = written(pairs.distinct(), f"{name}-pairs")
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        wanted = self.docs.sparkSession.sparkContext.broadcast(bit_filter(
            written(ids, f"{name}-candidates").select(F.xxhash64("id").alias("h")), "h")[1])
        signed = filtered(self.signed.select("doc_id", "t1", "t2"), ["doc_id"], wanted)
        for side in ("a", "b"):
            tops = signed.select(F.col("doc_id").alias(side), F.col("t1").alias(f"t1_{side}"), F.col("t2").alias(f"t2_{side}"))
            pairs = pairs.join(tops, side)
        pairs = pairs.filter(F.arrays_overlap("t1_a", "t1_b") & F.arrays_overlap("t2_a", "t2_b")).select("a", "b").distinct()
        pairs = written(pairs, f"{name}-kept")
        self.add(written(self.ordered(pairs, name).mapInPandas(_linked(self.n, self.percent), "u long, v long"), f"{name}-links"))

    def near(self, pa: Column, pb: Column) -> Column:
        """Length and position filter on a token common to two prefixes."""
        shared = F.least(F.col("n_a") - pa, F.col("n_b") - pb)
        return (enough(shared, F.col("n_a"), F.col("n_b"), self.percent)
                & (F.col("n_a") * 100 >= F.col("n_b") * self.percent)
                & (F.col("n_b") * 100 >= F.col("n_a") * self.percent))

    def meet(self, postings: DataFrame, centres: DataFrame) -> DataFrame:
        """Compares the members of postings with their centres and adds the links: (a, b, how, tokens, most) of those known,
        how being linked, close or far."""
        pairs = postings.join(centres, "token").select(
            F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("p_b"), F.col("one.id").alias("a"),
            F.col("one.n").alias("n_a"), F.col("one.pos").alias("p_a"))
        near = pairs.filter(F.col("a") != F.col("b")).filter(self.near(F.col("p_a"), F.col("p_b"))).select("a", "b")
        star = written(near.distinct(), "star")
        met = written(self.ordered(star, "star").mapInPandas(
            _met(self.n, self.percent), "a long, b long, linked boolean, known boolean, tokens array<long>, most int"), "met")
        self.add(met.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v")))
        # A doc_id with several sets is not known by its difference.
        once = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"), F.first(F.struct("linked", "known", "tokens", "most")).alias("x"))
        how = F.when(F.col("x.linked"), "linked").when(F.size("x.tokens") > 0, "close").otherwise("far")
        return written(once.filter("c = 1 AND x.known").select("a", "b", how.alias("how"), "x.tokens", "x.most"), "known")

    def components(self, name: str) -> DataFrame:
        return written(connected_components(self.links), f"{name}-cc").select(F.col("node").alias("id"), "component")

    def apart(self, postings: DataFrame, name: str) -> DataFrame:
        """Postings whose members are in different components, with the component."""
        held = postings.join(self.components(name), "id", "left").withColumn("component", F.coalesce("component", "id"))
        mixed = held.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
        return written(held.join(mixed.select("token"), "token", "left_semi"), f"{name}-held")

    def run(self, postings: DataFrame) -> None:
        centres = written(postings.groupBy("token").agg(F.min(F.struct("rare", "own", "id", "n", "pos")).alias("one")), "centres")
        known = self.meet(postings, centres)
        held = self.apart(postings, "across").join(centres.select("token", F.col("one.id").alias("a")), "token")
        held = held.join(known.select("a", F.col("b").alias("id"), "how"), ["a", "id"], "left").withColumn(
            "how", F.when(F.col("id") == F.col("a"), "linked").otherwise(F.coalesce("how", F.lit("unknown"))))
        held = written(held.drop("a"), "across-known")
        side = lambda s, *how: held.filter(F.col("how").isin(*how)).select("token", *[F.col(c).alias(f"{k}_{s}") for c, k in (
            ("id", "id"), ("n", "n"), ("pos", "p"), ("component", "c"))])
        apart = (F.col("c_a") != F.col("c_b")) & self.near(F.col("p_a"), F.col("p_b"))
        both = side("a", "far", "unknown").join(side("b", "far", "unknown"), "token").filter((F.col("id_a") < F.col("id_b")) & apart)
        mixed = [side("a", *x).join(side("b", y), "token").filter(apart) for x, y in ((("far", "unknown"), "close"), (("unknown",), "linked"))]
        differing = known.select("a", F.col("b").alias("id_a"), F.explode(F.slice("tokens", F.lit(1), F.col("most"))).alias("token")).join(
            known.filter("how = 'close'").select("a", F.col("b").alias("id_b"), F.explode("tokens").alias("token")), ["a", "token"]).select("id_a", "id_b")
        comp = self.components("differing")
        for s in ("a", "b"):
            differing = differing.join(comp.toDF(f"id_{s}", f"c_{s}"), f"id_{s}", "left").withColumn(f"c_{s}", F.coalesce(f"c_{s}", f"id_{s}"))
        pairs = differing.filter("c_a <> c_b").select("id_a", "id_b")
        for more in (both, *mixed):
            pairs = pairs.union(more.select("id_a", "id_b"))
        self.verify(pairs.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")), "across")


def jaccard_components(docs: DataFrame, n: int = N, percent: int = PERCENT, sample_rate: float | None = None,
                       seen: int = SEEN, group: int = GROUP) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text). Tokens are counted
    over all documents, so ``sample_rate`` (once the size of a sample) changes nothing."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    context = docs.sparkSession.sparkContext
    frequent = context.broadcast(frequent_tokens(docs, n, seen))
    signed = written(docs.mapInPandas(
        _signatures(n, percent, frequent), "doc_id long, n_shingles long, f1 long, f2 long, "
        "top array<long>, t1 array<int>, t2 array<int>"), "signatures")
    same = ["n_shingles", "f1", "f2"]
    some = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    first = some.groupBy(*same).agg(F.min("doc_id").alias("id"))
    classes = written(some.select("doc_id", *same).join(first, same).select("doc_id", "id", *same).distinct(), "classes")
    copies = written(classes.filter("doc_id <> id").select("doc_id", *same), "copies")
    # Most rows are no copy by a filter already, and only the others need the join.
    key = ["doc_id", *same]
    copied = context.broadcast(bit_filter(copies.select(F.xxhash64(*key).alias("h")), "h")[1])
    some = some.select(*key, "top")
    reps = filtered(some, key, copied, False).union(filtered(some, key, copied).join(copies, key, "left_anti"))
    # Written, so that no task runs two Python steps at once.
    reps = written(reps.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "top"), "representatives")
    tokens = reps.select(F.explode("top").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("c"))
    shared = context.broadcast(bit_filter(written(tokens.filter("c > 1").select("token"), "shared-tokens"), "token")[1])
    postings = reps.mapInPandas(_postings(shared, frequent), "id long, n long, pos long, token long, rare long, own long")
    join = _Join(docs, signed, n, percent, group)
    join.run(written(postings.distinct(), "postings"))

    # Copies of a set join through their class, near copies through links.
    edges = join.links.select("u", "v").union(classes.select(F.col("doc_id").alias("u"), F.col("id").alias("v")))
    comp = written(connected_components(edges), "join-components")
    out = signed.select("doc_id", "n_shingles").join(
        comp.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of linked ones: the smallest doc_id (a null one
    comes last). Rows without links stay, repeated rows of a kept doc_id once."""
    # Written with its key, so that every later read sees the same one.
    rows = written(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows", "zstd")
    groups = jaccard_components(rows.select(F.col(ROW).alias("doc_id"), "text"), n, percent)
    known = rows.select(ROW, "doc_id", F.md5(F.col("text").cast("binary")).alias("_text"))
    held = groups.withColumnRenamed("doc_id", ROW).join(known, ROW)
    # Texts without a shingle have no links; of them, rows that repeat in doc_id and text are one group.
    alone = (F.col("n_shingles") == 0) & F.col("doc_id").isNotNull()
    group = F.when(alone, F.struct(F.lit(None).cast("long").alias("c"), F.col("doc_id").cast("string").alias("d"), F.col("_text").alias("t"))).otherwise(
        F.struct(F.col("component_id").alias("c"), F.lit(None).cast("string").alias("d"), F.lit(None).cast("string").alias("t")))
    best = held.groupBy(group.alias("_g")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", ROW)).alias("best"))
    return rows.join(best.select(F.col(f"best.{ROW}").alias(ROW)), ROW, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id FROM w
LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS c FROM r GROUP BY a) m USING (doc_id)
"""
