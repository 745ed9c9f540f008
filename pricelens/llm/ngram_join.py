"""N-gram Jaccard join by parity sketches.

A text is the set of its hashed word shingles. Shingles are dealt to the parts of
a sketch by hash, and each flips one bit of its part, so the Hamming distance of
two sketches never exceeds the sets' symmetric difference. Sets that meet the
threshold differ in at most D shingles (D from the sizes of their band), so of
more than D parts one is untouched at least and agrees. A set with more than D
parts of two shingles or more joins on those alone, as one of them is untouched;
other sets join on all of their parts. (It is enough that one of two sets is of
the first kind, since equal parts are equally full.) This keeps empty parts, which
agree by chance, out of the join. Texts are joined on (band, part, XOR-hash of the
part); candidates are verified on the sets themselves.

Equal sets are one node. Within a batch, and then within a bucket, the nodes of
one sketch word are linked to the smallest of them only (a star). Candidates are
filtered by the Hamming distance of sketches with about one bit a shingle (a power
of two of words; a longer one is folded to a shorter one's length), and only what
is left has its sets compared. Stars whose verified links leave members in
different components are gone through again: first a spanning forest of the
members that are near each other, then, of what is still apart, all pairs. So no
link between components is lost, a group of copies costs a star, and pairs are
compared only where a star has failed; a large failed star is split into cells of
about ``CELL`` members.

A passage that many texts share fails a large star for each part that it fills alone.
A set that joins on r parts of two shingles or more, r above D, agrees with a linked
one on r - D of them at least. So it leaves r - D - 1 of its failed stars (``spare``),
the largest: all sets rank stars alike, so of what two linked sets share one is left
to both (the prefix filter of set joins; sets that join on all parts leave none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _words as W
from ._components import components
from ._exchange import SCHEMA, aside, buckets_for, exchange, groups, packs
from ._shared import release, settle

_U = np.uint64
#: Members of a failed star that are compared in one task.
CELL = 1000
#: Words of the sketches that candidates are filtered by, at least.
PARTS = 16
#: Pairs of a task that are looked at together.
_PAIRS = 200_000
_DOC_BITS = 12  # texts in a run at most 2**12; shingle hashes keep the other 52 bits
_SHINGLE = _U((1 << 64 - _DOC_BITS) - 1)


def shingle_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Run by run: (first text, end text, offsets, sorted distinct shingle hashes)."""
    for first, end, data, offsets in W.runs(texts, max_texts=1 << _DOC_BITS):
        low = W.LOWER[data]
        starts, ends = W.spans(~W.BLANK[data], offsets)
        at = np.searchsorted(starts, offsets)
        word = W.hash_spans(low, starts, ends)
        keys = []
        for m in range(1, n + 1):
            win = W.windows(word, m)
            where = W.text_of(starts[:len(win)], offsets)
            size = (at[1:] - at[:-1])[where]
            take = (np.arange(len(win)) + m <= at[where + 1]) & (size >= n if m == n else (size == m))
            keys.append((where[take].astype(np.uint64) << _U(64 - _DOC_BITS)) | (W.mix64(win[take] + _U(m)) & _SHINGLE))
        key = np.unique(np.concatenate(keys))
        yield first, end, np.searchsorted(key, np.arange(end - first + 1, dtype=np.uint64) << _U(64 - _DOC_BITS)), key & _SHINGLE


def nodes_of(offsets: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """64-bit identity of each set; that of the empty set is 0."""
    n = np.diff(offsets)
    total = np.zeros(len(shingles) + 1, np.uint64)
    np.cumsum(W.mix64(shingles + _U(0x9E3779B97F4A7C15)), out=total[1:])
    node = W.mix64(total[offsets[1:]] - total[offsets[:-1]] + W.mix64(n.astype(np.uint64)))
    return np.where(n > 0, node, _U(0))


class Bands:
    """Sizes fall into bands so that sets meeting ``num / den`` lie in one band or
    in neighbours; a set joins in its own band and in the next."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.edges = num, den, [1, 2]

    def of(self, sizes: np.ndarray) -> np.ndarray:
        while len(sizes) and self.edges[-1] <= sizes.max():
            self.edges.append(max(self.edges[-1] + 1, (self.edges[-1] - 1) * self.den // self.num + 1))
        return np.searchsorted(self.edges, sizes, side="right") - 1

    def difference(self, join: np.ndarray) -> np.ndarray:
        """Largest symmetric difference of linked sets in each join."""
        while len(join) and len(self.edges) <= join.max() + 1:
            self.edges.append(max(self.edges[-1] + 1, (self.edges[-1] - 1) * self.den // self.num + 1))
        return 2 * (np.array(self.edges)[join + 1] - 1) * (self.den - self.num) // (self.den + self.num)


def sketch(offsets: np.ndarray, shingles: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each set, words): parity sketches of ``parts`` words of 64 bits."""
    first = np.concatenate([[0], np.cumsum(parts)]).astype(np.int64)
    owner = np.repeat(np.arange(len(parts)), np.diff(offsets))
    part = ((shingles >> _U(20)) * parts[owner].astype(np.uint64)) >> _U(32)
    word = first[owner] + part.astype(np.int64)
    odd = (np.bincount(word * 64 + (shingles & _U(63)).astype(np.int64), minlength=first[-1] * 64) & 1).astype(np.uint8)
    return first, np.packbits(odd, bitorder="little").view("<u8")


def widths(sizes: np.ndarray) -> np.ndarray:
    """Words of a filter sketch: a power of two with a bit a shingle or more. Linked
    sets (at a similarity of 0.5 or more) have widths that differ by one fold at most."""
    return np.maximum(PARTS, 1 << np.ceil(np.log2(np.maximum(sizes, 1) / 64)).clip(0).astype(np.int64))


def part_words(offsets: np.ndarray, shingles: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first part of each set, words, shingles dealt to each part) of sketches
    with 2**20 bits a part, each part given by its XOR-hash: the exclusive or of a
    fixed random word for each of its odd bits. (Parts of 64 bits with a few
    shingles each would agree by chance.)"""
    first = np.concatenate([[0], np.cumsum(parts)]).astype(np.int64)
    owner = np.repeat(np.arange(len(parts)), np.diff(offsets))
    part = first[owner] + (((shingles >> _U(20)) * parts[owner].astype(np.uint64)) >> _U(32)).astype(np.int64)
    at, _ = groups(part)  # parts do not decrease, as each set's shingles are sorted
    words = np.zeros(first[-1], np.uint64)
    if len(part):
        words[part[at]] = np.bitwise_xor.reduceat(W.mix64(shingles & _U((1 << 20) - 1)), at)
    return first, words, np.bincount(part, minlength=first[-1])


def signed(bands: Bands, offsets: np.ndarray, shingles: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For the joins of each set, its own band's and the next one's: the signatures of
    all parts, each part's set, whether it is sent, and how many signatures that others
    rank highest a set may do without. The lowest bit of a signature is its join's."""
    size = np.diff(offsets)
    for more in (0, 1):
        join = bands.of(size) + more
        far = bands.difference(join)
        parts = (far + 1) * 3 // 2 + 1
        far = np.minimum(far, size * (bands.den - bands.num) // bands.num)  # from any linked set, by the own size
        first, words, dealt = part_words(offsets, shingles, parts)
        owner = np.repeat(np.arange(len(size)), parts)
        place = W.mix64(join[owner].astype(np.uint64) << _U(32) | (np.arange(len(words)) - first[owner]).astype(np.uint64))
        rich = dealt > 1
        some = np.bincount(owner, rich, len(size)).astype(np.int64)
        yield W.mix64(words ^ place) & ~_U(1) | (join[owner] & 1).astype(np.uint64), owner, rich | (some <= far)[owner], np.maximum(some - far - 1, 0)


_SIGNED = np.dtype([("sig", "<u8"), ("node", "<u8")])
_STAR = np.dtype([("sig", "<u8"), ("node", "<u8"), ("pivot", "<u8")])


def _stars(rec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stars, one record for each sketch word): every further node of a word is
    linked to the word's smallest node."""
    rec = rec[np.lexsort((rec["node"], rec["sig"]))]
    first, group = groups(rec["sig"])
    pivot = rec["node"][first][group]
    other = rec["node"] != pivot
    star = np.zeros(int(other.sum()), _STAR)
    for f in ("sig", "node"):
        star[f] = rec[f][other]
    star["pivot"] = pivot[other]
    return star, rec[first]


def _star_batch(star: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(star[f].astype(np.uint64).view(np.int64)) for f in ("sig", "node", "pivot")], names=["sig", "node", "pivot"])


def _classes(docs: DataFrame, id_col: str, text_col: str, n: int, num: int, den: int) -> DataFrame:
    """One row per row of ``docs``: _ll_key (hash of id and text), _ll_id,
    n_shingles and root (the class of linked sets; null for the empty set)."""
    if not 0 < num <= den:
        raise ValueError("the similarity must lie above 0 and at most at 1")
    narrow = docs.select(F.xxhash64(id_col, text_col).alias("_ll_key"), F.col(text_col).alias("_ll_text"), F.col(id_col).alias("_ll_id"))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [(np.diff(at), nodes_of(at, s)) for _, _, at, s in shingle_sets(b.column(1), n)]
            if parts:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(np.concatenate([p[0] for p in parts]).astype(np.int64)),
                                                  pa.array(np.concatenate([p[1] for p in parts]).view(np.int64))], names=["_ll_key", "_ll_id", "n_shingles", "node"])

    id_type = docs.schema[id_col].dataType.simpleString()
    slim = settle(narrow.mapInArrow(sizes, f"_ll_key bigint, _ll_id {id_type}, n_shingles bigint, node bigint"), "set-sizes")
    total = slim.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = buckets_for(5 * total * (den - num) / (den + num))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(num, den)
        for b in batches:
            seen, out = set(), []
            for _, _, at, shingles in shingle_sets(b.column(0), n):
                size, node = np.diff(at), nodes_of(at, shingles)
                fresh = [i for i, x in enumerate(node.tolist()) if x and not (x in seen or seen.add(x))]
                if not fresh:
                    continue
                fresh = np.array(fresh)
                own = np.zeros(len(size), bool)
                own[fresh] = True
                mine, where = shingles[np.repeat(own, size)], np.concatenate([[0], np.cumsum(size[fresh])])
                for sig, owner, send, _ in signed(bands, where, mine):
                    rec = np.zeros(int(send.sum()), _SIGNED)
                    rec["sig"], rec["node"] = sig[send], node[fresh][owner[send]]
                    out.append(rec)
            if out:
                star, rest = _stars(np.concatenate(out))
                yield packs(rest["sig"], rest, buckets)
                yield aside(star, int(star["sig"][0] % _U(1 << 30)) if len(star) else 0)

    def meet(key: int, held: list[bytes]) -> Iterator[pa.RecordBatch]:
        if key < 0:
            yield _star_batch(np.frombuffer(b"".join(held), _STAR))
        else:
            star, _ = _stars(np.frombuffer(b"".join(held), _SIGNED))
            if len(star):
                yield _star_batch(star)

    stars = settle(exchange(narrow.select("_ll_text").mapInArrow(sign, SCHEMA), meet, "sig bigint, node bigint, pivot bigint"), "sketch-stars")
    release(docs.sparkSession)
    pairs = settle(stars.select("node", "pivot").distinct(), "star-pairs")

    one = F.row_number().over(Window.partitionBy("_ll_key").orderBy("_ll_key"))

    def load(whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bands = Bands(num, den)
            for b in batches:
                for _, _, at, s in shingle_sets(b.column(0), n):
                    size = np.diff(at)
                    first, words = (at, s) if whole else sketch(at, s, widths(size))
                    spare = [] if whole else [pa.array(bands.of(size) & 1), *(pa.array(x) for *_, x in signed(bands, at, s))]
                    yield pa.RecordBatch.from_arrays([pa.array(nodes_of(at, s).view(np.int64)), pa.array(size), _lists(words.view(np.int64), first), *spare],
                                                     names=["node", "n", "sketch", *["_ll_own", "_ll_spare0", "_ll_spare1"][:len(spare)]])

        return run

    def loaded(of: DataFrame, whole: bool, name: str) -> DataFrame:
        """Sketches or sets of the nodes in pairs, from one text for each."""
        wanted = of.select("node").unionByName(of.select(F.col("pivot").alias("node"))).distinct()
        texts = slim.join(wanted, "node").groupBy("node").agg(F.min("_ll_key").alias("_ll_key")).select("_ll_key").distinct()
        # the candidates' ids grow with the corpus: the join is shuffled at every size
        texts = narrow.select("_ll_key", "_ll_text").join(texts.hint("merge"), "_ll_key").withColumn("_ll_k", one).where("_ll_k = 1").select("_ll_text")
        spare = "" if whole else ", _ll_own bigint, _ll_spare0 bigint, _ll_spare1 bigint"
        out = settle(texts.mapInArrow(load(whole), f"node bigint, n bigint, sketch array<bigint>{spare}"), name)
        release(docs.sparkSession)
        return out

    def verified(of: DataFrame, name: str) -> DataFrame | None:
        """The linked ones of the pairs; None where there are no pairs."""
        of = settle(of, f"{name}-near")
        if of.isEmpty():
            return None
        out = settle(_verified(of, loaded(of, True, f"{name}-sets"), num, den), name)
        release(docs.sparkSession)
        return out

    sketches = loaded(pairs, False, "candidate-sketches")
    found = verified(_near(pairs, sketches, num, den), "links")
    if found is None:
        found = pairs.limit(0)
    roots = settle(components(found, "node", "pivot"), "roots")

    # stars whose members did not all come together
    apart = pairs.join(roots.select("node", F.col("root").alias("rn")), "node", "left").join(roots.select(F.col("node").alias("pivot"), F.col("root").alias("rp")), "pivot", "left")
    apart = apart.where(F.coalesce("rn", "node") != F.coalesce("rp", "pivot")).select("node", "pivot")
    failed = stars.join(apart, ["node", "pivot"], "left_semi").select("sig").distinct()
    failed = settle(stars.join(failed, "sig"), "failed-stars")
    members = failed.select("sig", "node").unionByName(failed.select("sig", F.col("pivot").alias("node"))).distinct()
    # two members have been compared; each node leaves the largest stars that it may
    crowded = members.groupBy("sig").agg(F.count(F.lit(1)).alias("_ll_m")).where("_ll_m > 2")
    spares = sketches.select("node", "_ll_own", "_ll_spare0", "_ll_spare1")
    mine = F.col("sig").bitwiseAND(F.lit(1)) == F.col("_ll_own")
    place = F.row_number().over(Window.partitionBy("node", "_ll_mine").orderBy(F.desc("_ll_m"), F.desc("sig")))
    members = members.join(crowded, "sig").join(spares, "node").withColumn("_ll_mine", mine).withColumn("_ll_place", place)
    members = settle(members.where(F.col("_ll_place") > F.when(F.col("_ll_mine"), F.col("_ll_spare0")).otherwise(F.col("_ll_spare1"))).select("sig", "node"), "staying")
    # of stars with the same members one is enough
    large = members.groupBy("sig").agg(F.count(F.lit(1)).alias("_ll_m"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("_ll_h")).where("_ll_m > 1")
    large = large.groupBy("_ll_m", "_ll_h").agg(F.min("sig").alias("sig")).select("sig", F.ceil(F.col("_ll_m") / CELL).cast("int").alias("_ll_cells"))
    members = settle(members.join(large, "sig"), "members")
    release(docs.sparkSession)

    def across(forest: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = []  # rows of the cell that the last batch ended in
            for b in batches:
                if not len(b):
                    continue
                keys = np.stack([b.column(i).to_numpy() for i in range(3)])
                starts, _ = groups_of(keys)
                if held and [held[0].column(i)[0].as_py() for i in range(3)] == keys[:, 0].tolist():
                    held.append(b.slice(0, starts[1] if len(starts) > 1 else len(b)))
                    starts = starts[1:]
                if len(starts):
                    yield from _across(held, num, den, forest)
                    yield from _across([b.slice(starts[0], starts[-1] - starts[0])], num, den, forest)
                    held = [b.slice(starts[-1])]
            yield from _across(held, num, den, forest)

        return run

    for forest in (True, False):
        mine, other = F.pmod(F.xxhash64("node"), F.col("_ll_cells")).cast("int"), F.col("_ll_o")
        known = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        apart = known.groupBy("sig").agg((F.min("root") < F.max("root")).alias("_ll_apart")).where("_ll_apart").select("sig")
        known = known.join(apart, "sig").join(sketches.select("node", "n", "sketch"), "node")
        again = (known.withColumn("_ll_c", mine).withColumn("_ll_o", F.explode(F.sequence(F.lit(0), F.col("_ll_cells") - 1)))
                 .select("sig", F.least("_ll_c", other).alias("x"), F.greatest("_ll_c", other).alias("y"), "node", "root", "n", (F.col("_ll_c") <= other).alias("left"), "sketch"))
        dealt = again.repartition("sig", "x", "y").sortWithinPartitions("sig", "x", "y")
        name = "forest-links" if forest else "other-links"
        more = verified(dealt.mapInArrow(across(forest), "node bigint, pivot bigint").distinct(), name)
        if more is None:  # a forest of all pairs that may link is empty only if they are
            break
        # a component so far is the star of its root
        roots = settle(components(roots.select("node", F.col("root").alias("pivot")).unionByName(more), "node", "pivot"), "roots")
    return slim.join(roots, "node", "left").select("_ll_key", "_ll_id", "n_shingles", F.when(F.col("node") != 0, F.coalesce("root", "node")).alias("root"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``: component_id is
    the smallest id reachable by links, where two texts link when
    ``den * |intersection| >= num * |union|`` of their sets of ``n``-word
    shingles (ASCII letters lower-cased).

    Texts with fewer than ``n`` words are one shingle; null and empty texts have
    none, link with nothing and keep their own id. Repeated rows share a
    component; null ids take part, but a component is named by its smallest id
    that is not null (null if it has none). An empty table gives an empty
    result. Other columns are not read.
    """
    found = _classes(docs, id_col, text_col, n, num, den)
    least = found.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("_ll_id").alias("_ll_least"))
    return found.join(least, "root", "left").select(F.col("_ll_id").alias(id_col), "n_shingles",
                                                    F.when(F.col("root").isNull(), F.col("_ll_id")).otherwise(F.col("_ll_least")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each component of :func:`jaccard_components`: that with its
    smallest id (a null id only if there is no other; of rows with equal ids one
    of them). Rows without shingles are linked with nothing and all stay."""
    found = _classes(docs, id_col, text_col, n, num, den)
    first = (found.where(F.col("root").isNotNull()).groupBy("root")
             .agg(F.min(F.struct(F.col("_ll_id").isNull().alias("a"), F.col("_ll_id").alias("b"), F.col("_ll_key").alias("c"))).alias("m"))
             .select(F.col("m.c").alias("_ll_key"), F.lit(True).alias("_ll_one")))
    bare = found.where(F.col("root").isNull()).select("_ll_key", F.lit(False).alias("_ll_one")).distinct()
    chosen = docs.withColumn("_ll_key", F.xxhash64(id_col, text_col)).join(first.unionByName(bare), "_ll_key")
    again = F.row_number().over(Window.partitionBy("_ll_key").orderBy("_ll_key"))
    return chosen.withColumn("_ll_k", again).where("_ll_k = 1 or not _ll_one").select(*docs.columns)


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _near(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that sizes and sketches do not rule out."""
    a = sketches.select("node", F.col("n").alias("_ll_na"), F.col("sketch").alias("_ll_sa"))
    b = sketches.select(F.col("node").alias("pivot"), F.col("n").alias("_ll_nb"), F.col("sketch").alias("_ll_sb"))
    na, nb = F.col("_ll_na"), F.col("_ll_nb")

    def folded(c: str, to: str):
        half = F.transform(F.sequence(F.lit(0), (F.size(c) / 2 - 1).cast("int")), lambda i: F.get(c, (2 * i).cast("int")).bitwiseXOR(F.get(c, (2 * i + 1).cast("int"))))
        return F.when(F.size(c) > F.size(to), half).otherwise(F.col(c))

    both = pairs.join(a, "node").join(b, "pivot").where((na * den >= nb * num) & (nb * den >= na * num))
    one_fold = (F.size("_ll_sa") <= 2 * F.size("_ll_sb")) & (F.size("_ll_sb") <= 2 * F.size("_ll_sa"))  # else the sets decide
    apart = F.aggregate(F.zip_with(folded("_ll_sa", "_ll_sb"), folded("_ll_sb", "_ll_sa"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    return both.where(F.when(one_fold, apart * (den + num) <= (na + nb) * (den - num)).otherwise(True)).select("node", "pivot")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sets meet the threshold."""
    a = sets.select("node", F.col("sketch").alias("_ll_a"))
    b = sets.select(F.col("node").alias("pivot"), F.col("sketch").alias("_ll_b"))
    both = pairs.join(a, "node").join(b, "pivot")
    inter = F.size(F.array_intersect("_ll_a", "_ll_b"))
    return both.where(inter * den >= (F.size("_ll_a") + F.size("_ll_b") - inter) * num).select("node", "pivot")


def _fold(words: np.ndarray, width: int) -> np.ndarray:
    while words.shape[-1] > width:
        words = words[..., 0::2] ^ words[..., 1::2]
    return words


def _across(held: list[pa.RecordBatch], num: int, den: int, forest: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of a cell's members in different components whose sizes and sketches are
    near enough: all, or with ``forest`` as many as join what can be joined. The cells
    stand one after the other, each whole."""
    table = pa.Table.from_batches(held).combine_chunks() if held else []
    if len(table) < 2:
        return
    keys = np.stack([table[c].to_numpy() for c in ("sig", "x", "y")])
    node, root, size, left = (table[c].to_numpy() for c in ("node", "root", "n", "left"))
    whole = keys[1] == keys[2]
    first, cell = groups_of(keys)
    after = np.append(first[1:], len(node))[cell] - np.arange(len(node)) - 1  # members of the cell behind each
    lists = table["sketch"].chunk(0)
    flat, width = lists.flatten().to_numpy().view(np.uint64), lists.value_lengths().to_numpy().astype(np.int64)
    start, upto = np.cumsum(width) - width, np.concatenate([[0], np.cumsum(after)])
    up: dict[tuple, tuple] = {}  # components joined by what has been yielded

    def top(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    at = 0
    while at < len(node):  # some 200,000 pairs at a time, and a member's own at least
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + _PAIRS, side="right")) - 1)
        i = np.repeat(np.arange(at, end), after[at:end])
        j = i + 1 + np.arange(len(i)) - (upto[i] - upto[at])
        ok = (root[i] != root[j]) & (whole[i] | (left[i] != left[j])) & (size[i] * den >= size[j] * num) & (size[j] * den >= size[i] * num)
        i, j, at = i[ok], j[ok], end
        near = _gaps(flat, start, width, i, j) * (den + num) <= (size[i] + size[j]) * (den - num)
        i, j = i[near], j[near]
        if forest:
            fresh = np.zeros(len(i), bool)
            for k, (c, p, q) in enumerate(zip(cell[i].tolist(), root[i].tolist(), root[j].tolist())):
                p, q = top((c, p)), top((c, q))
                if p != q:
                    up[p], fresh[k] = q, True
            i, j = i[fresh], j[fresh]
        if len(i):
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(node[i], node[j])), pa.array(np.minimum(node[i], node[j]))], names=["node", "pivot"])


def groups_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position of each run of equal columns, and the run of each position."""
    new = np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(0)]
    return np.flatnonzero(new), np.cumsum(new) - 1


def _gaps(flat: np.ndarray, start: np.ndarray, width: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Hamming distances of the sketches of rows i and j, the longer one folded."""
    out, narrow = np.zeros(len(i), np.int64), np.minimum(width[i], width[j])
    for w in np.unique(narrow):
        at = np.flatnonzero(narrow == w)
        rows, where = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        words = np.empty((len(rows), w), np.uint64)
        for x in np.unique(width[rows]):
            mine = np.flatnonzero(width[rows] == x)
            words[mine] = _fold(flat[start[rows[mine]][:, None] + np.arange(x)], w)
        a, b = where[:len(at)], where[len(at):]
        step = max(1, _PAIRS * 4 // int(w))  # words of both sides: some 13 MB
        for k in range(0, len(at), step):
            out[at[k:k + step]] = np.bitwise_count(words[a[k:k + step]] ^ words[b[k:k + step]]).sum(1, dtype=np.int64)
    return out
