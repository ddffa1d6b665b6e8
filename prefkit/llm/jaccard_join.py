"""Jaccard join of shingle sets by token-combination prefixes.

A token is a shingle. Tokens stand in one global order, rare ones first (counted in a table of
hashed counters over all documents, of fixed size). A set's prefix is so long that two sets that are
similar enough must share more of it than they can miss. Rare tokens of a prefix are indexed one by
one. A frequent token alone would bring together documents that have nothing else in common, so
frequent tokens are dealt by hash to small parts and indexed as pairs within a part; as a part of p
tokens only vouches for p - 1 of them, the prefix is extended until the parts vouch for enough.

Sets that share an index key are candidates. Their number is kept linear: sets of one key are first
compared with one of them (its pivot), not with each other, and each with a few pivots at most. Where
this joins all sets of a key into one component, nothing else is to do; where components remain
apart, all pairs between different components of the key are verified too. Hence no link between
components is lost, while copies and near copies by the thousand cost a few comparisons each. Under keys
that many sets share, each set is first compared with a few neighbours in an order by chance, so that
what belongs together is mostly one component before all pairs are made. A set's
profile (how many of its tokens fall into each hash class) bounds the intersection from above and
spares the comparison of sets that cannot be similar. For long sets it is too coarse, so that their pairs
meet finer profiles, whose classes grow with the set, before they meet texts; all others read both complete sets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefkit.llm.common import concerned, shuffle_partitions, small_batches, written
from prefkit.llm.components import components
from prefkit.llm.shingles import set_prints, shingle_sets
from prefkit.llm.textblocks import byte_blocks, mixed

_U = np.uint64
#: Counters of the token frequency table (2 ** bits, 4 bytes each).
COUNTER_BITS = 22
#: A set's profile: which of PROFILE hash classes hold at least 1, 2, .. PLANES of its tokens (bits,
#: 64 to a number), and how many tokens lie beyond that.
PROFILE, PLANES = 128, 8
#: Sets of more tokens than FINE_FROM have a fine profile besides: counts of classes (a power of two, a byte each)
#: of more than half of FINE_TOKENS and at most FINE_TOKENS tokens on average.
FINE_FROM, FINE_TOKENS = 1024, 16
#: Undecided keys with more sets than this are crowded: their sets carry what spares pairs early.
CROWDED = 32
#: Crowded keys (the least ones) that a set lists. A pair is not met under a key when both sets list a lesser
#: one: under its least common key it is always met, and mostly under no other.
LISTED_KEYS = 16
#: Rounds in which only a few of the undecided pairs of each set are verified before all the others.
NARROWING = 2
#: Pivots that a set is compared with at first, those that it shares most keys with.
FIRST_PIVOTS = 3
#: Before crowded keys make all pairs, a set is compared with the NEAR_SETS sets after it under each of its
#: NEAR_KEYS least crowded keys.
NEAR_KEYS, NEAR_SETS = 8, 4
#: Bits of the map that tells a scan which documents are needed (4 MiB).
NEEDED_BITS = 25
#: Tokens are frequent if their counter is more than FREQUENT_SIGMAS standard deviations of chance
#: and FREQUENT_LEAST above the mean of all counters.
FREQUENT_SIGMAS, FREQUENT_LEAST = 6, 16
#: Index rows a task holds to bring together its own sets before the exchange.
HELD_ROWS = 1 << 20
#: Sets seen by a task that it remembers, so that copies are indexed once.
SEEN_SETS = 1 << 17
#: Sets of a key that meet its other sets in one task.
KEY_SHARE = 512
#: Comparisons with one pivot in one task.
PIVOT_SHARE = 256

_SETS = "doc_id long, n int, fp long, profile array<long>, fine binary, block int, counts binary"
_PA_SETS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int32()),
        ("fp", pa.int64()),
        ("profile", pa.list_(pa.int64())),
        ("fine", pa.binary()),
        ("block", pa.int32()),
        ("counts", pa.binary()),
    ]
)
_KEYS = "deal long, local boolean, key long, fp long, n int, pivot long, pivot_n int"
_PA_KEYS = pa.schema(
    [
        ("deal", pa.int64()),
        ("local", pa.bool_()),
        ("key", pa.int64()),
        ("fp", pa.int64()),
        ("n", pa.int32()),
        ("pivot", pa.int64()),
        ("pivot_n", pa.int32()),
    ]
)
_BLOCKS = 16


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def profiles(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sets' profiles, a row each."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    counts = np.bincount(owner * PROFILE + (h % _U(PROFILE)).astype(np.int64), minlength=n * PROFILE)
    counts = counts.reshape(n, PROFILE)
    planes = [np.packbits(counts >= k, axis=1).view(np.int64) for k in range(1, PLANES + 1)]
    return np.column_stack([*planes, np.maximum(counts - PLANES, 0).sum(1)])


def fine_profile(h: np.ndarray) -> bytes | None:
    """The set's tokens counted in hash classes, up to 255 in each; None for a short set."""
    if len(h) <= FINE_FROM:
        return None
    classes = 1 << (-(-len(h) // FINE_TOKENS) - 1).bit_length()
    counts = np.bincount((h & _U(classes - 1)).astype(np.int64), minlength=classes)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def most_common(a: bytes, n_a: int, b: bytes, n_b: int) -> int:
    """An upper bound of the intersection of two sets of ``n_a`` and ``n_b`` tokens by their fine profiles."""
    x, y = (np.frombuffer(p, np.uint8).astype(np.int64) for p in (a, b))
    # Tokens that the counts leave out may all be common.
    beyond = n_a - int(x.sum()) + n_b - int(y.sum())
    classes = min(len(x), len(y))
    return int(np.minimum(x.reshape(-1, classes).sum(0), y.reshape(-1, classes).sum(0)).sum()) + beyond


def _sets(width: int, bits: int):
    """Documents -> (doc_id, n, fp, profiles), and at a task's end its token counters in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << bits, np.int64)
        some = False
        for batch in batches:
            ids = batch.column("doc_id")
            for first, data, offsets in byte_blocks(batch.column("text")):
                h, bounds = shingle_sets(data, offsets, width)
                np.add.at(counters, (h >> _U(64 - bits)).astype(np.int64), 1)
                n = len(offsets) - 1
                some = True
                profile = profiles(h, bounds)
                fine = [fine_profile(h[b:e]) for b, e in zip(bounds[:-1], bounds[1:])]
                columns = [
                    ids.slice(first, n).cast(pa.int64()),
                    pa.array(np.diff(bounds).astype(np.int32)),
                    pa.array(_signed(set_prints(h, bounds))),
                    pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * profile.shape[1], profile.ravel()),
                    pa.array(fine, pa.binary()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=_PA_SETS)
        if some:
            kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if counters.max() <= np.iinfo(t).max)
            for i, part in enumerate(np.split(counters.astype(kind), _BLOCKS)):
                packed = bytes([part.itemsize]) + zlib.compress(part.tobytes(), 1)
                row = [[None], [None], [None], [None], [None], [i], [packed]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, _PA_SETS)], schema=_PA_SETS)

    return run


def _counters(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed[1:]), f"<u{packed[0]}").astype(np.int64)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counter blocks of many tasks -> one sum per block and task."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = _counters(packed)
            sums[block] = sums[block] + part if block in sums else part
    schema = pa.schema([("block", pa.int32()), ("counts", pa.binary())])
    rows = [(b, bytes([8]) + zlib.compress(s.astype("<u8").tobytes(), 1)) for b, s in sums.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def token_counters(blocks: DataFrame, bits: int) -> np.ndarray:
    """The counters over all documents, summed block by block; 2 ** bits values, whatever the input."""
    parts = blocks.select("block", "counts").repartition(_BLOCKS, "block")
    out = np.zeros((_BLOCKS, (1 << bits) // _BLOCKS), np.int64)
    for row in parts.mapInArrow(_added, "block int, counts binary").collect():
        out[row["block"]] += _counters(bytes(row["counts"]))
    return out.reshape(-1)


class Prefixes:
    """Index keys of sets for the similarity num / den."""

    def __init__(self, num: int, den: int, counters: np.ndarray, frequent: int):
        self.num, self.den, self.counters, self.frequent = num, den, counters, frequent
        self.shift = _U(64 - (len(counters) - 1).bit_length())

    def most_missing(self, size):
        """How many tokens of a set of ``size`` a similar one can lack."""
        return size - -(-self.num * size // self.den)

    def levels(self, size: int) -> range:
        """Size levels (powers of two) that similar sets can belong to."""
        low, high = -(-self.num * size // self.den), self.den * size // self.num
        return range(max(low, 1).bit_length(), high.bit_length() + 1)

    def parts(self, level: int) -> int:
        """Parts that frequent tokens are dealt to at a level: about three tokens of a prefix each."""
        return max(1, self.most_missing(1 << (level - 1)) // 2)

    def keys(self, h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, index of the set) for sets given as ascending hashes."""
        size = np.diff(bounds)
        owner = np.repeat(np.arange(len(size)), size)
        count = self.counters[(h >> self.shift).astype(np.int64)]
        order = np.lexsort((h, count, owner))
        h, count = h[order], count[order]
        need = self.most_missing(size) + 1
        rare = count <= self.frequent
        n_rare = np.add.reduceat(np.append(rare, False).astype(np.int64), bounds[:-1]) * (size > 0)
        nth = np.arange(len(h)) - bounds[:-1][owner]
        single = rare & (nth < need[owner])
        keys, owners = [mixed(h[single])], [owner[single]]
        for i in np.flatnonzero((n_rare < need) & (size > 1)).tolist():
            tokens = h[bounds[i] + n_rare[i] : bounds[i + 1]]
            for level in self.levels(int(size[i])):
                made = self.pairs(tokens, level, int(need[i] - n_rare[i]))
                keys.append(made)
                owners.append(np.full(len(made), i))
        return np.concatenate(keys), np.concatenate(owners)

    def pairs(self, tokens: np.ndarray, level: int, need: int) -> np.ndarray:
        """Pairs within the parts of the shortest prefix of frequent ``tokens`` that vouches for
        ``need`` of them."""
        part = (mixed(tokens) % _U(self.parts(level))).astype(np.int64)
        # A token vouches if an earlier one of the prefix is in its part.
        firsts = np.zeros(len(tokens), bool)
        firsts[np.unique(part, return_index=True)[1]] = True
        vouched = np.cumsum(~firsts)
        if vouched[-1] < need:
            raise ValueError("the similarity is too low for pair prefixes of such a set")
        end = int(np.searchsorted(vouched, need)) + 1
        h, part = tokens[:end], part[:end]
        order = np.lexsort((h, part))
        h, part = h[order], part[order]
        out = []
        step = 1
        while True:  # partners at distance ``step`` within a part
            same = part[step:] == part[:-step]
            if not same.any():
                break
            out.append(mixed(h[:-step][same] * _U(0xD1342543DE82EF95) ^ h[step:][same] + _U(level)))
            step += 1
        return np.concatenate(out) if out else h[:0]


def _index(width: int, prefixes):
    """Documents -> index keys of their distinct sets. Keys that several sets of the task share are
    brought together here: the sets go to a pivot, and the key goes on with the pivot alone."""

    def flushed(held):
        key, fp, n = (np.concatenate(part) for part in held)
        for part in held:
            part.clear()
        order = np.lexsort((fp, key))
        key, fp, n = key[order], fp[order], n[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])
        key, fp, n = key[new], fp[new], n[new]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        pivot = np.flatnonzero(first)[np.cumsum(first) - 1]
        shared = ~first
        shared[:-1] |= ~first[1:]
        # Members stay where they are dealt by themselves; a key's first set stands for it elsewhere.
        for rows, local in ((np.flatnonzero(shared), True), (np.flatnonzero(first), False)):
            at = pivot[rows]
            for cut in range(0, len(rows), 1 << 17):
                r, p = rows[cut : cut + (1 << 17)], at[cut : cut + (1 << 17)]
                deal = mixed(key[r] ^ fp[r]) if local else key[r]
                columns = [
                    pa.array(_signed(deal)),
                    pa.array(np.full(len(r), local)),
                    pa.array(_signed(key[r])),
                    pa.array(_signed(fp[r])),
                    pa.array(n[r]),
                    # Where the key's sets are brought together its pivot is chosen anew.
                    pa.array(_signed(fp[p]) if local else np.zeros(len(r), np.int64)),
                    pa.array(n[p] if local else np.zeros(len(r), np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=_PA_KEYS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = prefixes.value
        seen: set[int] = set()
        held: tuple[list, list, list] = ([], [], [])
        rows = 0
        for batch in batches:
            for _, data, offsets in byte_blocks(batch.column("text")):
                h, bounds = shingle_sets(data, offsets, width)
                fps = set_prints(h, bounds)
                size = np.diff(bounds)
                fresh = []
                for i, fp in enumerate(fps.tolist()):
                    if size[i] and fp not in seen:
                        fresh.append(i)
                        if len(seen) < SEEN_SETS:
                            seen.add(fp)
                fresh = np.array(fresh, np.int64)
                own = np.zeros(len(size), bool)
                own[fresh] = True
                h = h[np.repeat(own, size)]
                size, fps = size[own], fps[own]
                keys, owner = index.keys(h, np.concatenate([[0], np.cumsum(size)]))
                for part, values in zip(held, (keys, fps[owner], size[owner].astype(np.int32))):
                    part.append(values)
                rows += len(keys)
                if rows > HELD_ROWS:
                    yield from flushed(held)
                    rows = 0
        if rows:
            yield from flushed(held)

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of (local, key, fp) -> members of keys that at least two sets share, with
    the key's pivot. A key's first row waits until a second one comes; nothing else is held."""
    names = ["key", "fp", "n", "pivot", "pivot_n"]
    last = None  # the row before, and whether it was given out
    for batch in batches:
        local = batch.column("local").to_numpy(zero_copy_only=False)
        if local.any():
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(local)) for c in names], names)
        key, fp, n = (batch.column(c).to_numpy()[~local] for c in ("key", "fp", "n"))
        if not len(key):
            continue
        if last is not None:
            key, fp, n = (np.concatenate([[a], b]) for a, b in zip(last[:3], (key, fp, n)))
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(first)[np.cumsum(first) - 1]
        pivot, pivot_n = fp[at], n[at]
        begun = last is not None and last[3] is not None
        if begun:  # the key had begun in an earlier batch, with a pivot of its own
            same = at == 0
            pivot[same], pivot_n[same] = last[3]
        shared = ~first
        shared[:-1] |= ~first[1:]
        give = shared & (fp != pivot) | shared & first
        if begun:
            give[0] = False  # given out before
        rows = np.flatnonzero(give)
        if len(rows):
            columns = [key[rows], fp[rows], n[rows].astype(np.int32), pivot[rows], pivot_n[rows].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
        more = bool(shared[-1])
        last = (key[-1], fp[-1], n[-1], (pivot[-1], pivot_n[-1]) if more else None)


def _needed(bitmap, width: int):
    """Rows whose hashed id is set in the bitmap (all that are needed, and a few others), with the
    fingerprint of their set. Of rows that repeat an id with equal sets a task gives one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(bitmap.value, np.uint8)
        seen: set[tuple] = set()
        for batch in batches:
            h = batch.column("slot").to_numpy().astype(np.int64)
            hit = (held[h >> 3] >> (h & 7).astype(np.uint8)) & 1
            batch = batch.filter(pa.array(hit.astype(bool)))
            ids, texts = batch.column("doc_id"), batch.column("text")
            for first, data, offsets in byte_blocks(texts):
                fps = _signed(set_prints(*shingle_sets(data, offsets, width)))
                fresh = []
                for i, name in enumerate(zip(ids.slice(first, len(fps)).to_pylist(), fps.tolist())):
                    if name not in seen:
                        fresh.append(i)
                        if len(seen) < SEEN_SETS:
                            seen.add(name)
                columns = [ids.slice(first, len(fps)), pa.array(fps), texts.slice(first, len(fps))]
                yield pa.RecordBatch.from_arrays([c.take(pa.array(fresh, pa.int64())) for c in columns], ["doc_id", "fp", "text"])

    return run


def _possible(num: int, den: int):
    """Pairs with their sizes and fine profiles -> those (a, b) that these do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("fine", "n", "b_fine", "b_n")))
            keep = [a is None or b is None or most_common(a, n, b, m) * (num + den) >= (n + m) * num for a, n, b, m in rows]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _compared(width: int, num: int, den: int):
    """Rows in the order of (b, part, member): a pivot's text, then the texts to compare with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pivot = None, np.zeros(0, np.uint64)
        for batch in batches:
            keys = list(zip(batch.column("b").to_pylist(), batch.column("part").to_pylist()))
            members = batch.column("a").to_pylist()
            out = []
            for first, data, offsets in byte_blocks(batch.column("text")):
                h, bounds = shingle_sets(data, offsets, width)
                for i in range(len(offsets) - 1):
                    tokens = h[bounds[i] : bounds[i + 1]]
                    if members[first + i] is None:
                        own, pivot = keys[first + i], tokens
                    elif keys[first + i] == own and len(tokens):
                        both = len(np.intersect1d(tokens, pivot, assume_unique=True))
                        if den * both >= num * (len(tokens) + len(pivot) - both):
                            out.append((members[first + i], own[0]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    return run


class JaccardJoin:
    """The join of one table of documents; see ``jaccard_components``."""

    def __init__(self, docs: DataFrame, width: int, num: int, den: int, id_col: str, text_col: str, bits: int):
        if not 3 * den <= 4 * num <= 4 * den:
            raise ValueError("the similarity must be from 0.75 to 1")
        self.spark, self.width, self.num, self.den, self.bits = docs.sparkSession, width, num, den, bits
        small_batches(self.spark)
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def sets(self) -> DataFrame:
        """doc_id, n, fp of every row; leaves the counters and the classes of equal sets: fp (which names the
        class), n, rep (the least doc_id), profile, fine."""
        made = written(self.docs.mapInArrow(_sets(self.width, self.bits), _SETS), "shingle-sets")
        counters = token_counters(made.filter("block IS NOT NULL"), self.bits)
        mean = counters.sum() / len(counters)
        frequent = int(mean + FREQUENT_SIGMAS * mean**0.5) + FREQUENT_LEAST
        counters = np.minimum(counters, np.iinfo(np.int32).max).astype(np.int32)
        self.prefixes = Prefixes(self.num, self.den, counters, frequent)
        rows = made.filter("block IS NULL")
        classes = rows.filter("n > 0").groupBy("fp")
        same = [F.first(c).alias(c) for c in ("n", "profile", "fine")]
        classes = classes.agg(*same, F.min("doc_id").alias("rep"))
        self.classes = written(classes, "shingle-classes")
        return rows.select("doc_id", "n", "fp")

    def members(self) -> DataFrame:
        """(key, a, n, b, b_n) of the keys that several sets share: b is the key's pivot."""
        held = self.spark.sparkContext.broadcast(self.prefixes)
        keys = self.docs.mapInArrow(_index(self.width, held), _KEYS)
        dealt = keys.repartition(shuffle_partitions(self.spark), "deal").sortWithinPartitions("local", "key", "fp")
        met = dealt.mapInArrow(_met, "key long, fp long, n int, pivot long, pivot_n int")
        named = met.select("key", F.col("fp").alias("a"), "n", F.col("pivot").alias("b"), F.col("pivot_n").alias("b_n"))
        return written(named, "key-members")

    def sizes_fit(self, a: str, b: str) -> Column:
        low, high = F.least(a, b).cast("long"), F.greatest(a, b).cast("long")
        return low * self.den >= high * self.num

    def profiles_fit(self, n_a: str, n_b: str, profile_a: str, profile_b: str) -> Column:
        """Whether the profiles leave room for a large enough intersection: it has at most as many tokens
        as classes that both sets fill, plane by plane, and the smaller rest beyond the planes."""
        words = PLANES * PROFILE // 64
        a, b = F.col(profile_a), F.col(profile_b)
        most = F.least(a[words], b[words])
        for i in range(words):
            most = most + F.bit_count(a[i].bitwiseAND(b[i]))
        sizes = F.col(n_a).cast("long") + F.col(n_b).cast("long")
        return most * (self.num + self.den) >= sizes * self.num

    def possible(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (a, b) of classes without those that their fine profiles rule out. Short sets have none."""
        fine = self.classes.filter("fine IS NOT NULL").select(F.col("fp").alias("a"), "n", "fine")
        other = fine.withColumnsRenamed({"a": "b", "n": "b_n", "fine": "b_fine"})
        rows = pairs.select("a", "b").join(fine, "a", "left").join(other, "b", "left")
        return rows.mapInArrow(_possible(self.num, self.den), "a long, b long")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes whose complete sets are similar enough. A class without any doc_id
        cannot be read again and is linked with nothing."""
        # A pivot with many members is dealt to several tasks; there are few of these pivots.
        counts = pairs.groupBy("b").agg(F.ceil(F.count("*") / PIVOT_SHARE).cast("int").alias("shares"))
        hot = written(counts.filter("shares > 1"), "hot-pivots")
        shares = F.coalesce("shares", F.lit(1))
        part = F.pmod(F.xxhash64("a"), shares).cast("int").alias("part")
        members = pairs.join(hot, "b", "left").select(F.col("a").alias("fp"), "b", part, "a")
        part = F.explode(F.sequence(F.lit(0), shares - 1)).alias("part")
        pivots = pairs.select("b").distinct().join(hot, "b", "left")
        pivots = pivots.select(F.col("b").alias("fp"), "b", part, F.lit(None).cast("long").alias("a"))
        names = self.classes.filter("rep IS NOT NULL").select("fp", F.col("rep").alias("doc_id"))
        wanted = written(members.unionByName(pivots).join(names, "fp"), "compared-ids")
        # 32,768 slots in each bitmap, so 2 ** NEEDED_BITS / 32,768 rows of 4 KiB at most.
        slots = 1 << NEEDED_BITS
        slot = F.pmod(F.xxhash64("doc_id"), F.lit(slots))
        maps = wanted.groupBy(F.bitmap_bucket_number(slot + 1).alias("k"))
        maps = maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot + 1)).alias("m"))
        bitmap = bytearray(slots // 8)
        for row in maps.collect():
            at = (row["k"] - 1) * 4096
            bitmap[at : at + len(row["m"])] = row["m"]
        held = self.spark.sparkContext.broadcast(bytes(bitmap))
        found = self.docs.withColumn("slot", slot).mapInArrow(_needed(held, self.width), "doc_id long, fp long, text string")
        # A text crosses one exchange to all comparisons that want it and one to their tasks. Of the rows with
        # that doc_id those with the class's set are read; they are alike for the comparison. A row that is
        # repeated in the table comes once per task at most: comparing it again changes nothing.
        rows = found.join(wanted, ["doc_id", "fp"])
        dealt = rows.repartition(shuffle_partitions(self.spark), "b", "part")
        dealt = dealt.sortWithinPartitions("b", "part", F.col("a").asc_nulls_first()).select("b", "part", "a", "text")
        return written(dealt.mapInArrow(_compared(self.width, self.num, self.den), "a long, b long"), "links")

    def links(self) -> DataFrame:
        """Links between classes: enough of them to give the components of all of them."""
        members = self.members()
        profiles = self.classes.select(F.col("fp").alias("a"), F.col("n"), F.col("profile"))
        others = profiles.select(F.col("a").alias("b"), F.col("n").alias("b_n"), F.col("profile").alias("b_profile"))
        stars = members.filter(F.col("a") != F.col("b")).filter(self.sizes_fit("n", "b_n"))
        shared = stars.groupBy("a", "b").agg(F.count("*").alias("keys"))
        nth = F.row_number().over(Window.partitionBy("a").orderBy(F.col("keys").desc(), "b"))
        stars = shared.withColumn("nth", nth).filter(F.col("nth") <= FIRST_PIVOTS).select("a", "b")
        stars = stars.join(profiles, "a").join(others, "b")
        stars = stars.filter(self.profiles_fit("n", "b_n", "profile", "b_profile")).select("a", "b")
        stars = written(stars, "star-pairs")
        links = self.verified(written(self.possible(stars), "possible-stars"))
        # Keys whose sets are still in different components: the pairs between these.
        found = written(components(links), "star-components")
        sets = members.select("key", "a", "n").distinct().join(found.withColumnRenamed("id", "a"), "a", "left")
        sets = written(sets.withColumn("component", F.coalesce("component", "a")), "key-sets")
        mixed_sets = written(sets.join(self.undecided(sets), "key"), "mixed-sets")
        pairs = self.sparse_pairs(mixed_sets.filter(F.col("size") <= CROWDED), profiles, others)
        crowded = mixed_sets.filter(F.col("size") > CROWDED)
        tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        near = written(self.neighbours(crowded, profiles).join(tried, ["a", "b"], "left_anti"), "near-pairs")
        if not near.isEmpty():
            tried = tried.unionByName(near)
            near = written(self.possible(near), "possible-near")
            links = written(links.unionByName(self.verified(near)), "links-so-far")
            found = written(components(links), "components-so-far").withColumnRenamed("id", "a")
            crowded = crowded.drop("component", "main", "size").join(found, "a", "left")
            crowded = written(crowded.withColumn("component", F.coalesce("component", "a")), "near-sets")
            crowded = written(crowded.join(self.undecided(crowded), "key"), "crowded-sets")
        pairs = pairs.unionByName(self.crowded_pairs(crowded, profiles))
        pairs = written(pairs.distinct(), "apart-pairs").join(tried, ["a", "b"], "left_anti")
        return self.settled(links, written(self.possible(pairs), "untried-pairs"))

    def undecided(self, sets: DataFrame) -> DataFrame:
        """(key, main, size) of the keys whose sets are in several components; main has most of them."""
        counts = sets.groupBy("key", "component").count()
        largest = counts.groupBy("key").agg(
            F.max(F.struct("count", "component")).alias("m"), F.count("*").alias("parts"), F.sum("count").alias("size")
        )
        return largest.filter("parts > 1").select("key", F.col("m.component").alias("main"), "size")

    def sparse_pairs(self, sets: DataFrame, profiles: DataFrame, others: DataFrame) -> DataFrame:
        """Pairs (a < b) of different components under keys that few sets share: ids meet, and profiles
        are looked up once for each distinct pair."""
        sets = sets.select("key", "a", "n", "component")
        right = sets.withColumnsRenamed({"a": "b", "n": "b_n", "component": "other"})
        met = sets.join(right, "key").filter("a < b AND component != other").filter(self.sizes_fit("n", "b_n"))
        met = written(met.select("a", "b").distinct(), "sparse-pairs")
        met = met.join(profiles, "a").join(others, "b")
        return met.filter(self.profiles_fit("n", "b_n", "profile", "b_profile")).select("a", "b")

    def listed(self, sets: DataFrame, profiles: DataFrame) -> DataFrame:
        """a, profile, keys of ``sets``: the least of each set's keys, LISTED_KEYS of them."""
        keys = sets.groupBy("a").agg(F.slice(F.sort_array(F.collect_list("key")), 1, LISTED_KEYS).alias("keys"))
        return keys.join(profiles.drop("n"), "a")

    def neighbours(self, sets: DataFrame, profiles: DataFrame) -> DataFrame:
        """A few pairs (a < b) of different components for each set: keys are hashes, so similar sets mostly
        list the same ones, and under each a set meets those that follow it in an order by chance."""
        rows = sets.groupBy("a", "n", "component").agg(F.sort_array(F.collect_list(F.struct("key", "size"))).alias("keys"))
        rows = rows.withColumn("k", F.explode(F.slice("keys", 1, NEAR_KEYS))).drop("keys")
        rows = rows.join(profiles.drop("n"), "a")
        share = F.pmod(F.xxhash64("a"), F.ceil(F.col("k.size") / KEY_SHARE)).alias("share")
        one = F.struct("a", "n", "component", "profile").alias("x")
        chance = F.xxhash64("a", "k.key").alias("chance")
        rows = rows.select(F.col("k.key").alias("key"), share, chance, one)
        order = Window.partitionBy("key", "share").orderBy("chance")
        rows = rows.select("x", F.array(*[F.lead("x", i).over(order) for i in range(1, NEAR_SETS + 1)]).alias("after"))
        met = rows.select("x", F.explode("after").alias("y")).filter("y IS NOT NULL AND x.component != y.component")
        met = met.filter(self.sizes_fit("x.n", "y.n")).filter(self.profiles_fit("x.n", "y.n", "x.profile", "y.profile"))
        return met.select(F.least("x.a", "y.a").alias("a"), F.greatest("x.a", "y.a").alias("b")).distinct()

    def crowded_pairs(self, sets: DataFrame, profiles: DataFrame) -> DataFrame:
        """Pairs (a < b) of different components under keys that many sets share. Sizes, profiles and
        lists of keys are compared where the sets meet, so that few of the pairs leave the join."""
        shares = F.ceil(F.col("size") / KEY_SHARE).cast("int").alias("shares")
        rest = sets.select("key", "a", "n", "component", "main", shares)
        rest = rest.join(written(self.listed(sets, profiles), "crowded-lists"), "a")
        # Few bytes and many pairs: a key's sets are dealt to shares, and the number of tasks is fixed. Those outside
        # its main component, mostly few, go to every share: rows grow with them and not with the key's square.
        names = {"a": "b", "n": "b_n", "component": "other", "profile": "b_profile", "keys": "b_keys"}
        left = rest.filter("component != main").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        right = rest.withColumn("share", F.pmod(F.xxhash64("a"), F.col("shares")).cast("int"))
        right = right.drop("main", "shares").withColumnsRenamed(names)
        tasks = shuffle_partitions(self.spark)
        left = left.drop("shares").repartition(tasks, "key", "share")
        right = right.repartition(tasks, "key", "share")
        first = F.array_min(F.array_intersect("keys", "b_keys")) >= left["key"]
        apart = left.join(
            right,
            (left["key"] == right["key"])
            & (left["share"] == right["share"])
            & (F.col("component") != F.col("other"))
            # Of two sets outside the key's main component each is on either side.
            & ((F.col("other") == F.col("main")) | (F.col("a") < F.col("b")))
            & self.sizes_fit("n", "b_n")
            & self.profiles_fit("n", "b_n", "profile", "b_profile")
            & F.coalesce(first, F.lit(True)),
        )
        return apart.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    def settled(self, links: DataFrame, pairs: DataFrame) -> DataFrame:
        """``links`` with those among ``pairs``, as far as they join components. A few pairs of each set are
        verified first; pairs that this puts into one component need no comparison."""
        for last in [False] * NARROWING + [True]:
            if pairs.isEmpty():
                break
            some = pairs
            if not last:
                by = F.xxhash64("a", "b")
                of_a = F.row_number().over(Window.partitionBy("a").orderBy(by))
                of_b = F.row_number().over(Window.partitionBy("b").orderBy(by))
                some = pairs.withColumn("i", of_a).withColumn("j", of_b)
                some = written(some.filter(F.least("i", "j") <= FIRST_PIVOTS).select("a", "b"), "narrow-pairs")
            links = written(links.unionByName(self.verified(some)), "links-so-far")
            if not last:
                found = written(components(links), "components-so-far")
                own = found.select(F.col("id").alias("a"), F.col("component").alias("c"))
                far = found.select(F.col("id").alias("b"), F.col("component").alias("d"))
                pairs = pairs.join(some, ["a", "b"], "left_anti").join(own, "a", "left").join(far, "b", "left")
                apart = F.coalesce("c", "a") != F.coalesce("d", "b")
                pairs = written(pairs.filter(apart).select("a", "b"), "pairs-apart")
        return links


def jaccard_components(
    docs: DataFrame,
    width: int,
    num: int,
    den: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int = COUNTER_BITS,
) -> DataFrame:
    """Components of documents linked by den * |intersection| >= num * |union| of their shingle sets.

    Returns one row per row of ``docs``: doc_id, n_shingles (int), component_id (the least doc_id
    reachable by links, itself included). A text without words (or null) has no shingles and is
    linked with nothing; a text of fewer than ``width`` words is one shingle. Repeated rows and equal
    sets are linked. An empty table gives no rows. Only the id and text columns are read.
    """
    join = JaccardJoin(docs, width, num, den, id_col, text_col, bits)
    rows = join.sets()
    found = components(join.links()).withColumnRenamed("id", "fp")
    classes = join.classes.select("fp", "rep").join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    classes = written(classes, "class-components")
    least = classes.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = classes.join(least, "component").select("fp", "component_id")
    out = rows.join(named, "fp", "left")
    return out.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def drop_similar(docs: DataFrame, width: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text"):
    """``docs`` with one document of each component, that of the least id; all columns are kept.
    Rows without an id are kept. Of repeated rows (equal ids) all stay or go together."""
    found = jaccard_components(docs, width, num, den, id_col, text_col)
    drop = found.filter("doc_id != component_id").select(F.col("doc_id").alias("_drop_id")).distinct()
    drop = written(drop, "near-drops")
    own = F.col(f"`{id_col}`").cast("long")
    # Only rows whose id may be among those to go meet them; the other texts stay where they lie.
    may, rest = concerned(docs, own, drop)
    return rest.union(may.join(drop, own == F.col("_drop_id"), "left_anti"))
