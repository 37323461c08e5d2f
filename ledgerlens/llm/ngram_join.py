"""N-gram Jaccard join with adaptive multi-match prefixes.

Sets: the distinct five-word shingles of each whole text, as 64-bit hashes computed on whole Arrow
batches. Equal sets fold into one class. Tokens (48 bits and their bucket) go through one exchange,
packed as bytes per bucket; each bucket counts the classes of its tokens and returns only tokens
that at least two classes share, so most documents end there.

Prefixes: every class orders its tokens by (document frequency, token). Two sets of similarity t
or more share at least l tokens within their l-prefixes, the first n - ceil(t n) + l tokens.
Each class chooses its l by estimated cost: reading the postings of the prefix, plus verifying the
candidates that l shared tokens let through. A pair is a candidate if its chosen prefixes share at
least the smaller of both l. Tokens of one class alone come first in every order and can't match.

Links: pairs within a posting list grow with its square, so they are not all made. In hub rounds
each class is verified against one class only, the hub that most of its prefix tokens name: the
class of the list whose tokens are the most frequent, so the middle of a group of near copies.
Verified links merge classes into components, and posting lists within one component drop out. When
a round merges little, the last step makes all pairs between different components that meet in a
posting list, each pair once, at the first token that their prefixes share. No link that could
change a component is lost. Verification first counts the shared prefix tokens against the smaller
l, then the shared tokens exactly.

Cases: null or blank texts have no shingles and no links, one component each; texts under five
words have one shingle, the whole sequence; equal texts and repeated rows are linked; ties in the
order break by token; null ids never become a component's id unless all its ids are null; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import BLANKS, pinned, row_key, shuffle_partitions

WIDTH = 5
NUM, DEN = 75, 100  # similarity of two linked sets: shared * DEN >= union * NUM
LONGEST = 32  # largest l that the cost estimate considers
PART_BYTES = 1 << 19  # of texts that are cut into words at once: a byte takes about 60 while they are
ROWS_AT_ONCE = 256  # decoded at once
FLUSH_TOKENS = 1 << 20
BUCKET_BYTES = 12 << 20  # text bytes that one bucket of tokens stands for
HUB_ROUNDS = 4
LITTLE = 0.1  # a round that links a smaller share of its pairs, or closes a smaller share of the postings, is the last
BLOCK_BYTES = 16 << 20  # token bytes that one group of pairs is verified with
TOKEN_BYTES = 6

_U = np.uint64
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BASE = _U(0x9E3779B97F4A7C15)
_STEP = _rng.integers(1, 1 << 63, WIDTH, dtype=np.uint64) | _U(1)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def shingle_sets(texts: Iterable[str | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, in order."""
    held: list[bytes] = []
    size = 0
    for t in texts:
        held.append((t or "").encode() + b"\n")
        size += len(held[-1])
        if size >= PART_BYTES:
            yield from _sets_of(held, width)
            held, size = [], 0
    if held:
        yield from _sets_of(held, width)


def _decoded(column: pa.Array) -> Iterator[str | None]:
    for lo in range(0, len(column), ROWS_AT_ONCE):
        yield from column.slice(lo, ROWS_AT_ONCE).to_pylist()


def _sets_of(held: list[bytes], width: int) -> Iterator[np.ndarray]:
    data = np.frombuffer(b"".join(held), dtype=np.uint8)
    ends = np.cumsum([len(x) for x in held])
    blank = _BLANK[data]
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    if not len(starts):
        yield from (np.zeros(0, dtype=np.uint64) for _ in held)
        return
    letters = np.flatnonzero(~blank)
    word = np.searchsorted(starts, letters, "right") - 1
    place = letters - starts[word]
    powers = _powers(int(place.max()) + 1)
    values = _BYTE[data[letters]] * powers[place]
    first = np.searchsorted(letters, starts)
    words = _mix(np.add.reduceat(values, first))
    bounds = np.searchsorted(starts, np.concatenate(([0], ends)))
    n = len(words)
    rolled = np.zeros(max(0, n - width + 1), dtype=np.uint64)
    for k in range(width):
        rolled += words[k:k + len(rolled)] * _STEP[k]
    rolled = _mix(rolled)
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        if hi - lo >= width:
            yield np.unique(rolled[lo:hi - width + 1])
        elif hi > lo:  # the whole sequence; its length keeps it apart from shingles
            with np.errstate(over="ignore"):
                yield _mix(np.array([(words[lo:hi] * _STEP[:hi - lo]).sum() + _U(hi - lo)], dtype=np.uint64) ^ _BASE)
        else:
            yield np.zeros(0, dtype=np.uint64)


def set_class(tokens: np.ndarray) -> int:
    """64-bit identity of a set."""
    with np.errstate(over="ignore"):
        mixed = _mix(_mix(tokens ^ _STEP[0]).sum(dtype=np.uint64, keepdims=True) + _U(len(tokens)) * _STEP[1])
    return int(mixed.view(np.int64)[0])


def _token_blobs(docs: DataFrame, buckets: int, width: int) -> DataFrame:
    """(bucket, docs, tokens): per task and bucket the classes with their tokens in that bucket.
    ``info`` rows (doc_id, key, n, class) ride along in the bucket of their batch."""
    schema = "bucket int, classes binary, lengths binary, counts binary, tokens binary, ids binary, no_id binary, keys binary, sizes binary, own binary"

    def flush(ident, keys, sets, turn) -> Iterator[pa.RecordBatch]:
        n = np.array([len(s) for s in sets], dtype=np.int64)
        own = np.array([set_class(s) for s in sets], dtype=np.int64)
        _, at = np.unique(own, return_index=True)  # equal sets of one batch go once
        at = at[n[at] > 0]
        tokens = np.concatenate([sets[i] for i in at]) if len(at) else np.zeros(0, dtype=np.uint64)
        which = np.repeat(np.arange(len(at)), n[at])
        bucket = ((tokens >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        tokens, which, bucket = tokens[order], which[order], bucket[order]
        edges = np.searchsorted(bucket, np.arange(buckets + 1))
        low = tokens.view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES]
        home = turn % buckets
        none = b""
        info = (np.array([x or 0 for x in ident], dtype=np.int64).tobytes(), np.array([x is None for x in ident], dtype=np.uint8).tobytes(),
                np.array(keys, dtype=np.int64).tobytes(), n.tobytes(), own.tobytes())
        rows = []
        for b in range(buckets):
            lo, hi = edges[b], edges[b + 1]
            if hi > lo or b == home:
                here, counts = np.unique(which[lo:hi], return_counts=True)
                rows.append((b, own[at[here]].tobytes(), n[at[here]].astype(np.uint32).tobytes(), counts.astype(np.uint32).tobytes(), low[lo:hi].tobytes(), *(info if b == home else [none] * 5)))
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                                         names=[x.split()[0] for x in schema.split(", ")])

    def emit(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        turn = TaskContext.get().partitionId()
        ident: list = []
        keys: list = []
        sets: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for own, key, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingle_sets(_decoded(batch.column(2)), width), strict=True):
                ident.append(own)
                keys.append(key)
                sets.append(s)
                held += len(s)
                if held >= FLUSH_TOKENS or len(sets) > 50_000:
                    yield from flush(ident, keys, sets, turn)
                    ident, keys, sets, held, turn = [], [], [], 0, turn + 1
        if sets:
            yield from flush(ident, keys, sets, turn)

    return docs.mapInArrow(emit, schema)


_POSTINGS = ("home int, classes binary, lengths binary, counts binary, tokens binary, dfs binary, "
             "doc_id long, key long, n long, class long")


def _raw(column: pa.ChunkedArray, row: int, kind: str) -> np.ndarray:
    return np.frombuffer(column[row].as_py(), dtype=kind)


def _bucket_postings(buckets: int):
    def postings(blobs: pa.Table) -> pa.Table:
        """One bucket: tokens that two classes or more share, with their document frequency, packed
        by the home of their class (home >= 0); and the info rows that came along (home -1)."""
        prefix = int(blobs.column("bucket")[0].as_py()) & 0x7FFF
        info: list[tuple[np.ndarray, ...]] = []
        ends = np.cumsum(pc.binary_length(blobs.column("tokens")).to_numpy().astype(np.int64) // TOKEN_BYTES)
        token, owner, length = (np.zeros(ends[-1], dtype=kind) for kind in (np.int64, np.int64, np.uint32))
        wide = token.view(np.uint8).reshape(-1, 8)
        for row, end in enumerate(ends.tolist()):
            counts = _raw(blobs.column("counts"), row, "u4")
            packed = _raw(blobs.column("tokens"), row, "u1").reshape(-1, TOKEN_BYTES)
            here = slice(end - len(packed), end)
            wide[here, :TOKEN_BYTES] = packed
            owner[here] = np.repeat(_raw(blobs.column("classes"), row, "i8"), counts)
            length[here] = np.repeat(_raw(blobs.column("lengths"), row, "u4"), counts)
            if blobs.column("sizes")[row].as_py():
                info.append((_raw(blobs.column("ids"), row, "i8"), _raw(blobs.column("no_id"), row, "u1"), _raw(blobs.column("keys"), row, "i8"),
                             _raw(blobs.column("sizes"), row, "i8"), _raw(blobs.column("own"), row, "i8")))
        order = np.lexsort((owner, token))
        token = token[order]  # one after the other, so that two copies of one column are held at most
        owner = owner[order]
        length = length[order]
        del order, wide
        first = np.ones(len(token), dtype=bool)
        first[1:] = token[1:] != token[:-1]
        fresh = first.copy()  # a class from several batches counts once
        fresh[1:] |= owner[1:] != owner[:-1]
        token, owner, length, first = token[fresh], owner[fresh], length[fresh], first[fresh]
        df = np.diff(np.append(np.flatnonzero(first), len(token)))
        df = np.repeat(df, df)
        shared = df > 1
        token, owner, length, df = token[shared] | np.int64(prefix << 48), owner[shared], length[shared], df[shared].astype(np.uint32)
        home = (_mix(owner.view(np.uint64)) % _U(buckets)).astype(np.int32)
        order = np.lexsort((owner, home))
        token, owner, length, df, home = token[order], owner[order], length[order], df[order], home[order]
        new = np.ones(len(owner), dtype=bool)
        new[1:] = owner[1:] != owner[:-1]
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(owner))).astype(np.uint32)
        homes, from_row = np.unique(home, return_index=True)
        to_row = np.append(from_row[1:], len(home))
        blob = []
        for lo, hi in zip(from_row, to_row, strict=True):
            x, y = np.searchsorted(at, (lo, hi))
            blob.append((owner[at[x:y]].tobytes(), length[at[x:y]].tobytes(), counts[x:y].tobytes(), token[lo:hi].tobytes(), df[lo:hi].tobytes()))
        cat = [np.concatenate([x[i] for x in info]) if info else np.zeros(0, dtype=np.int64) for i in range(5)]
        k, none = len(cat[0]), [None] * len(homes)
        packed_columns = list(zip(*blob, strict=True)) or [()] * 5
        names = [x.split()[0] for x in _POSTINGS.split(", ")]
        return pa.table([
            pa.array([*homes.tolist(), *[-1] * k], pa.int32()), *(pa.array([*c, *[None] * k], pa.binary()) for c in packed_columns),
            pa.array([*none, *(None if gone else i for i, gone in zip(cat[0].tolist(), cat[1].tolist(), strict=True))], pa.int64()),
            *(pa.array([*none, *c.tolist()], pa.int64()) for c in cat[2:])], names=names)

    return postings


def needed(n: int) -> int:
    """Tokens that a set of n shares at least with any similar set: ceil(t n)."""
    return -(-n * NUM // DEN)


def choose_prefix(n: int, dfs: np.ndarray) -> tuple[int, int]:
    """(l, length of the l-prefix without the tokens of this class alone) of least estimated cost.
    ``dfs``: ascending document frequencies of the shared tokens. (0, 0): no set can be similar."""
    alone = n - len(dfs)
    start = n - needed(n) + 1 - alone
    if start <= 0:
        return 0, 0
    most = min(LONGEST, len(dfs) - start + 1, needed(n))
    read = np.cumsum(dfs - 1)[start - 1:start - 1 + most]
    l = np.arange(1, most + 1)
    # reading costs one step a posting; l matches let through at most read / l candidates, each of
    # which is verified at the cost of merging two sets
    cost = read + read / l * math.sqrt(n)
    best = int(np.argmin(cost))
    return best + 1, start + best


_CLASSES = "class long, n long, m long, l int, prefix array<long>, tokens binary, central double"


def _class_rows(blobs: pa.Table) -> pa.Table:
    """Classes of one home: their shared tokens (m of them) ascending, and the chosen prefix."""
    token = np.concatenate([_raw(blobs.column("tokens"), r, "i8") for r in range(blobs.num_rows)])
    df = np.concatenate([_raw(blobs.column("dfs"), r, "u4") for r in range(blobs.num_rows)]).astype(np.int64)
    counts = np.concatenate([_raw(blobs.column("counts"), r, "u4") for r in range(blobs.num_rows)])
    owner = np.repeat(np.concatenate([_raw(blobs.column("classes"), r, "i8") for r in range(blobs.num_rows)]), counts)
    length = np.repeat(np.concatenate([_raw(blobs.column("lengths"), r, "u4") for r in range(blobs.num_rows)]), counts)
    order = np.lexsort((token, df, owner))
    token, df, owner, length = token[order], df[order], owner[order], length[order]
    classes, at = np.unique(owner, return_index=True)
    out: list[tuple] = []
    for name, lo, hi in zip(classes.tolist(), at, np.append(at[1:], len(owner)), strict=True):
        n = int(length[lo])
        l, size = choose_prefix(n, df[lo:hi])
        if l:
            out.append((name, n, int(hi - lo), l, token[lo:lo + size], np.sort(token[lo:hi]).tobytes(), float(df[lo:hi].sum() / n)))
    columns = list(zip(*out, strict=True)) or [()] * 7
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.float64()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _CLASSES.split(", ")])


def _verify(pairs: pa.Table, sets: pa.Table) -> pa.Table:
    """(ca, cb) of the pairs of one block whose prefixes share enough tokens and whose sets are similar."""
    row = {c: i for i, c in enumerate(sets.column("class").to_pylist())}
    n, l = sets.column("n").to_pylist(), sets.column("l").to_pylist()
    prefixes = sets.column("prefix").combine_chunks()
    values, edges = prefixes.values.to_numpy(), prefixes.offsets.to_numpy()
    prefix = [np.sort(values[lo:hi]) for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
    tokens = [np.frombuffer(x.as_buffer(), dtype=np.int64) for x in sets.column("tokens")]
    ok = []
    for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
        i, j = row[a], row[b]
        similar = len(np.intersect1d(prefix[i], prefix[j], assume_unique=True)) >= min(l[i], l[j])
        if similar:
            shared = len(np.intersect1d(tokens[i], tokens[j], assume_unique=True))
            similar = shared * DEN >= (n[i] + n[j] - shared) * NUM
        ok.append(similar)
    return pairs.select(["ca", "cb"]).filter(pa.array(ok, pa.bool_()))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(ca, cb) of the similar pairs (a, b, ca, cb, na, nb). Pairs are cut into blocks by a and by b,
    large blocks into pieces, so a set goes once to each piece that needs it and not once per pair."""
    total = pairs.agg(F.sum(F.col("na") + F.col("nb")).alias("s")).first()["s"] or 0
    side = math.ceil(math.sqrt(max(shuffle_partitions(pairs.sparkSession), 8 * total / BLOCK_BYTES)))
    x, y = F.pmod(F.xxhash64("a"), F.lit(side)), F.pmod(F.xxhash64("b"), F.lit(side))
    keyed = pairs.withColumn("block", x * side + y)
    pieces = (keyed.groupBy(F.col("block").alias("of"))
              .agg(F.ceil(F.sum(F.col("na") + F.col("nb")) * 8 / F.lit(BLOCK_BYTES)).alias("pieces")))
    keyed = (keyed.join(pieces, F.col("block") == F.col("of"))
             .select("block", F.pmod(F.xxhash64("a", "b"), F.greatest("pieces", F.lit(1))).alias("piece"), "a", "b", "ca", "cb"))
    wanted = keyed.select(F.col("block").alias("to"), F.col("piece").alias("part"), F.explode(F.array("a", "b")).alias("class")).distinct()
    needed_sets = wanted.join(sets.select("class", "n", "l", "prefix", "tokens"), "class")
    return (keyed.groupBy("block", "piece").cogroup(needed_sets.groupBy("to", "part"))
            .applyInArrow(_verify, "ca long, cb long"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node of each node's component, for all nodes with an edge.
    Labels move to the smallest among a node and its neighbours, then jump to their own label,
    until nothing changes; every round combines on the map side and is checkpointed."""
    both = pinned(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                  .unionByName(edges.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct())
    labels = both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("u")).alias("root"))
    labels = pinned(labels)
    while True:
        near = (both.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("root").alias("near")))
        low = labels.join(near, F.col("node") == F.col("u")).select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("at"), F.col("root").alias("further"))
        new = pinned(low.join(jump, F.col("root") == F.col("at"), "left")
                     .select("node", "was", F.least("root", F.coalesce("further", "root")).alias("root")))
        changed = new.where("was <> root").limit(1).count()
        labels = new.select("node", "root")
        if not changed:
            return labels


def _narrow(chosen: DataFrame) -> DataFrame:
    """Postings of the chosen prefixes in five numbers: class, token, comp, sizes (n and m) and order (how
    little the class serves as a hub, and the token's place in the prefix)."""
    # a positive float's bits ascend with it: 2^31 - 1 less them puts the most frequent tokens first
    little = F.lit((1 << 31) - 1) - F.least(F.floor(F.log2(F.col("central") + 1) * (1 << 24)), F.lit((1 << 31) - 1))
    return (chosen.select("class", F.col("class").alias("comp"), (F.shiftleft(F.col("n"), 32) + F.col("m")).alias("sizes"),
                          little.cast("long").alias("little"), F.posexplode("prefix").alias("place", "token"))
            .select("class", "token", "comp", "sizes", (F.shiftleft(F.col("little"), 32) + F.col("place")).alias("order")))


def _place(order: Column) -> Column:
    return order.bitwiseAND((1 << 32) - 1).cast("int")


def _little(order: Column) -> Column:
    return F.shiftright(order, 32)


def _n(sizes: Column) -> Column:
    return F.shiftright(sizes, 32)


def _m(sizes: Column) -> Column:
    return sizes.bitwiseAND((1 << 32) - 1)


def _open(postings: DataFrame) -> DataFrame:
    """Postings of tokens that still join different components."""
    mixed = postings.groupBy(F.col("token").alias("t")).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    return postings.join(mixed.select("t"), F.col("token") == F.col("t"), "left_semi")


def _fits(na: Column, ma: Column, nb: Column, mb: Column) -> Column:
    """Lengths, and the numbers of tokens that any other class has, allow the similarity."""
    return ((F.least(na, nb) * DEN >= F.greatest(na, nb) * NUM) & (F.least(ma, mb) * (NUM + DEN) >= (na + nb) * NUM))


def _band(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / math.log(1.15)).cast("int")


def candidate_pairs(postings: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Pairs (a, b, ca, cb, na, nb) of classes of different components whose prefixes meet, each pair
    once: at the first token that both prefixes hold, so what stands before it in them is disjoint.
    The larger set probes the bands of lengths that its partners can have: from t n up to
    (1 + 1/t) m - n, as at most m of its n tokens occur elsewhere. Sets that cannot be the smaller
    one of a pair aren't probed. A first shared token at places p and q of the shared tokens leaves an
    overlap of at most min(m - p, m' - q), and at most min(s - p, s' - q) shared tokens of prefixes
    of s and s' tokens, of which the smaller l must be found."""
    postings = (postings.select("class", "token", "comp", _place(F.col("order")).alias("place"))
                .join(prefixes.select(F.col("class").alias("of"), "n", "m", "l", "prefix"), F.col("class") == F.col("of")))
    common = ["token", "n", "m", "l", "comp", "place", F.size("prefix").alias("s"), F.slice("prefix", F.lit(1), F.col("place")).alias("before")]
    postings = postings.select("class", *common)
    top = F.least("n", F.floor(F.col("m") * (NUM + DEN) / NUM).cast("long") - F.col("n"))
    low = F.ceil(F.col("n") * NUM / DEN).cast("long")

    def named(side: str) -> list[Column]:
        return [F.col("class").alias(side), *(F.col(c).alias(c[0] + side) for c in ("n", "m", "l", "comp", "place", "before")), F.col("s").alias("s" + side), "token"]

    left = (postings.withColumns({"top": top, "low": low}).where("top >= low")
            .select(*named("a"), F.explode(F.sequence(_band(F.col("low")), _band(F.col("top")))).alias("band")))
    right = (postings.where(F.col("m") * (NUM + DEN) >= 2 * NUM * F.col("n"))
             .select(*named("b"), _band(F.col("n")).alias("band")))
    smaller = (F.col("nb") < F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("b") < F.col("a")))
    overlap = F.least(F.col("ma") - F.col("pa"), F.col("mb") - F.col("pb"))
    possible = (_fits(F.col("na"), F.col("ma"), F.col("nb"), F.col("mb")) & (overlap * (NUM + DEN) >= (F.col("na") + F.col("nb")) * NUM)
                & (F.least(F.col("sa") - F.col("pa"), F.col("sb") - F.col("pb")) >= F.least("la", "lb")))
    first = ~F.arrays_overlap("ba", "bb")
    return (left.join(right, ["token", "band"]).where((F.col("ca") != F.col("cb")) & smaller & possible & first)
            .select("a", "b", "ca", "cb", "na", "nb"))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """doc_id, key (hash of id and text), n (shingles), class, comp: rows of one ``comp`` are linked.
    Rows without shingles have comp null."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("key"), body.alias("text"))
    volume = docs.agg(F.sum(F.octet_length(body)).alias("s")).first()["s"] or 0
    buckets = int(max(shuffle_partitions(spark) // 2, 1, min(math.ceil(volume / BUCKET_BYTES), 1 << 15)))
    postings = pinned(_token_blobs(narrow, buckets, width).repartition(buckets, "bucket").groupBy("bucket")
                      .applyInArrow(_bucket_postings(buckets), _POSTINGS))
    info = postings.where("home = -1").select("doc_id", "key", "n", "class")
    chosen = pinned(postings.where("home >= 0").select("home", "classes", "lengths", "counts", "tokens", "dfs")
                    .groupBy("home").applyInArrow(_class_rows, _CLASSES))
    open_ = pinned(_open(_narrow(chosen)))
    merges: list[DataFrame] = []

    def merge(pairs: DataFrame) -> int:
        """Verify pairs, merge what they link; number of links."""
        nonlocal open_
        links = pinned(verified(pairs, chosen).distinct())
        n = links.count()
        if n:
            merges.append(components(links, "ca", "cb"))
            roots = merges[-1].withColumnRenamed("root", "merged")
            open_ = pinned(_open(open_.join(roots, F.col("comp") == F.col("node"), "left")
                                 .withColumn("comp", F.coalesce("merged", "comp")).drop("node", "merged")))
        return n

    size = open_.count()
    for turn in range(HUB_ROUNDS):
        # the hub of a posting list: its class of the most frequent tokens; later, one of a quarter drawn anew
        drawn = F.lit(0) if not turn else F.least(F.pmod(F.xxhash64("class", F.lit(turn)), F.lit(4)), F.lit(1))
        rank = F.struct(drawn.alias("d"), _little(F.col("order")).alias("r"), F.col("class").alias("c"))
        hubs = open_.groupBy(F.col("token").alias("t")).agg(F.min_by(F.struct("class", "sizes", "comp"), rank).alias("hub"))
        sizes, others = F.col("sizes"), F.col("hub.sizes")
        named = (open_.join(hubs, F.col("token") == F.col("t")).where((F.col("hub.comp") != F.col("comp")) & _fits(_n(sizes), _m(sizes), _n(others), _m(others)))
                 .groupBy("class", "comp", "sizes", "hub").agg(F.count(F.lit(1)).alias("shared")))
        best = named.groupBy(F.col("class").alias("a"), F.col("comp").alias("ca"), "sizes").agg(F.max_by("hub", F.struct("shared", F.col("hub.class").alias("h"))).alias("hub"))
        pairs = pinned(best.select("a", "ca", _n(sizes).alias("na"), F.col("hub.class").alias("b"), F.col("hub.comp").alias("cb"), _n(others).alias("nb")))
        before = pairs.count()
        if not before or merge(pairs) < before * LITTLE:
            break
        was, size = size, open_.count()
        if size > was * (1 - LITTLE):
            break
    merge(pinned(candidate_pairs(open_, chosen)))
    comps = info.where("n > 0").select("class").distinct().withColumn("comp", F.col("class"))
    for roots in merges:
        comps = (comps.join(roots, F.col("comp") == F.col("node"), "left")
                 .select("class", F.coalesce("root", "comp").alias("comp")))
    comps = comps.where("comp <> class").select(F.col("class").alias("c"), F.col("comp").alias("moved"))
    return (info.join(comps, F.col("class") == F.col("c"), "left")
            .select("doc_id", "key", "n", "class", F.when(F.col("n") > 0, F.coalesce("moved", "class")).alias("comp")))


def component_ids(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id per row."""
    rows = pinned(join(docs, doc_id, text))
    least = rows.where("comp is not null").groupBy(F.col("comp").alias("c")).agg(F.min("doc_id").alias("least"))
    return (rows.join(least, F.col("comp") == F.col("c"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of linked rows (the smallest id, then the smallest key), all columns.
    Rows without words stay."""
    rows = join(docs, doc_id, text).where("comp is not null")
    first = rows.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("gone"), "doc_id", "key")).alias("f"))
    keys = first.select(F.col("f.key").alias("key")).distinct()
    blank = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(BLANKS)) == ""
    with_words = docs.where(~blank)
    packed = with_words.select(F.struct("*").alias("row"), row_key(F.col(doc_id), F.col(text)).alias("k"))
    one = (packed.join(keys, F.col("k") == F.col("key"), "left_semi")
           .withColumn("number", F.row_number().over(Window.partitionBy("k").orderBy("k"))).where("number = 1"))
    return docs.where(blank).unionByName(one.select("row.*"))
