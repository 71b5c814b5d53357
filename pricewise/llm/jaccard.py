"""N-gram Jaccard join by token-combination prefixes (operator 4).

A document is the set of its distinct 5-word shingles. Two documents link when
``100 * |A & B| >= 75 * |A | B|``. Equal sets are one *entity*, so copies cost
one row each and are never paired.

**Filter.** Shingles have one global order: estimated frequency class first,
hash second. The frequencies are counted over all documents into a table of
fixed size (``CELLS`` counters). A set of n shingles shares at least
ceil(0.75 n) with any partner, so at most ``n - ceil(0.75 n)`` of its shingles
are missing there. Rare shingles index alone; frequent ones (more than twice
the mean load + 32) index only in pairs, and the prefix is one shingle longer
for each group of frequent ones in use, because a lone shared one gives no pair:
``rare + sum over groups (frequent - 1) >= n - ceil(0.75 n) + 1``. If two
documents link, then one of them has all the shared part of its prefix inside
the other's prefix and so shares a single rare shingle or a frequent pair. To
keep the pairs linear, frequent shingles fall into ``2**level`` groups by hash,
``level`` following the set size; a set indexes at its own level and the next.

Each entry states the most that its set can share with a partner if the entry is
where their first common shingle lies: the shingles from there on, or, for pairs of
frequent ones, all but the rare. A linked pair shares 3 / 7 of both sizes together, so
pairs whose entries allow less are no candidates there; the first common shingle's own
entry never fails this.

**Candidates.** Index entries are sorted by signature and singletons dropped.
Within a signature a member is compared with a hub, not with all others; members
that already are in one component need no comparison. The hub is the member with the
fewest shingles before the signature, so the least changed of near copies: most of the
others link with it, and the same few are hubs of many signatures. A hub has met all at
its signature and leaves it. Hub rounds go on until the pairs left to compare are few
against the entries or stop shrinking; then all pairs of different components that still
share a signature are compared, each made at few of the signatures it shares. Every link
between different components is found, so components are exact. Each round joins
components by its own links alone.

**Verification.** Parity bits of the sets (half a byte per shingle) bound the
difference of two sets from below and drop most pairs that don't link; what is
left is verified exactly on the sets (64-bit shingle hashes), which are made again
from the texts of these documents alone.

Defined cases: a null or blank text has an empty set, n_shingles 0 and links
with nothing; 1 to 4 words are one shingle; repeated rows are equal sets and so
one component; a null id never names a component unless all its members are
null; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewise.llm.common import components, drop_stage, fresh, materialize, release
from pricewise.llm.ragged import U64, mix, shingle_hashes, slices, text_bytes

CELLS = 1 << 22
BLOCKS = 64
_MASK = U64(CELLS - 1)
#: Signatures before one that tell whether a pair has met already.
PASSED = 8
#: Frequent shingles of one group in an average document of a level.
GROUP = 8


def entity(shingles: np.ndarray) -> int:
    """64-bit id of a set, as a signed long."""
    return int(mix(mix(shingles).sum(dtype=U64, keepdims=True) + U64(len(shingles))).astype(np.int64)[0])


def parity(shingles: np.ndarray) -> bytes:
    """One bit for each of 4 n or more cells: whether an odd number of shingles fall
    into it. Sets that differ in d shingles differ in d bits at most."""
    width = 1 << max(6, int(4 * len(shingles) - 1).bit_length())
    return np.packbits(np.bincount((shingles & U64(width - 1)).astype(np.int64), minlength=width) & 1).tobytes()


def _close(batches):
    """The pairs (a, b, n, m, and more columns but the parities) whose parities allow a
    link: linked sets differ in (n + m) / 7 shingles at most."""
    for batch in batches:
        keep = []
        for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n", "m", "pa", "pb"))):
            x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
            while len(x) != len(y):  # half as wide: cells a half apart meet
                if len(x) > len(y):
                    x, y = y, x
                y = y[:len(y) // 2] ^ y[len(y) // 2:]
            keep.append(7 * int(np.bitwise_count(x ^ y).sum()) <= n + m)
        rest = [c for c in batch.schema.names if c not in ("n", "m", "pa", "pb")]
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in rest], names=rest)


def _sets(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    data, off = text_bytes(batch.column(name))
    for i, j in slices(off):
        yield i, j, shingle_hashes(data[off[i]:off[j]], off[i:j + 1] - off[i])


def _describe(docs: DataFrame) -> DataFrame:
    """(doc_id, entity, n, parity) per row, and after them the partition's counters
    (block, counts) with a null n. Only the first of a batch's equal sets has its parity."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("entity", T.LongType()),
                           T.StructField("n", T.LongType()), T.StructField("parity", T.BinaryType()),
                           T.StructField("block", T.IntegerType()), T.StructField("counts", T.BinaryType())])

    def run(batches):
        load, kind = np.zeros(CELLS, np.int64), None
        for batch in batches:
            ids, sizes, bits, seen = [], [], [], set()
            kind = batch.column("doc_id").type
            for _, _, sets in _sets(batch, "text"):
                for s in sets:
                    ids.append(entity(s))
                    sizes.append(len(s))
                    bits.append(None if ids[-1] in seen else parity(s))
                    if ids[-1] not in seen:
                        seen.add(ids[-1])
                        np.add.at(load, (s & _MASK).astype(np.int64), 1)
            k = len(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(bits, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names=schema.names)
        if kind is not None:
            parts = load.reshape(BLOCKS, -1)
            for b in range(BLOCKS):
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                     pa.array([b], pa.int32()),
                     pa.array([zlib.compress(np.minimum(parts[b], 65535).astype(np.uint16).tobytes(), 1)], pa.binary())], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _merge_counts(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, raw in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            part = np.frombuffer(zlib.decompress(raw), np.uint16).astype(np.int64)
            total[b] = total[b] + part if b in total else part
    for b, load in total.items():
        code = np.minimum(255, np.floor(8 * np.log2(1 + load))).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([code.tobytes()], pa.binary())],
                                         names=["block", "counts"])


def _frequency_codes(described: DataFrame) -> tuple[np.ndarray, int]:
    """Log-scale frequency of each cell (one byte, ``CELLS`` bytes in all), and the
    code above which a cell is frequent."""
    parts = described.where("block IS NOT NULL").select("block", "counts").repartition(BLOCKS, "block") \
        .mapInArrow(_merge_counts, "block int, counts binary").collect()  # CELLS bytes at any size of input
    codes = np.zeros((BLOCKS, CELLS // BLOCKS), np.uint8)
    for row in parts:
        codes[row["block"]] = np.frombuffer(row["counts"], np.uint8)
    mean = (described.agg(F.sum("n")).first()[0] or 0) / CELLS
    return codes.reshape(-1), min(254, int(8 * np.log2(1 + 2 * mean + 32)))


def signatures(shingles: np.ndarray, codes: np.ndarray, frequent: int) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of one set (see the module's docstring), and for each the most
    that the set can share with a partner whose first common shingle is here."""
    n = len(shingles)
    if n < 3:
        return shingles[:0], np.zeros(0, np.int32)  # links with equal sets only
    key = np.sort((codes[(shingles & _MASK).astype(np.int64)].astype(U64) << U64(56)) | (shingles >> U64(8)))
    need = n - (3 * n + 3) // 4 + 1
    rare = int(np.searchsorted(key, U64(frequent + 1) << U64(56)))
    if rare >= need:
        return mix(key[:need]), n - np.arange(need, dtype=np.int32)
    out, tail = [mix(key[:rare])], key[rare:]
    # sizes of two linked sets differ by 4/3 at most, so their levels by 1 at most
    own = max(0, int(np.floor(np.log2(n / GROUP))))
    for level in (own, own + 1):
        group = (mix(tail) & U64((1 << level) - 1)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        first = np.empty(len(tail), bool)  # the first of its group adds nothing
        first[order] = np.r_[True, np.diff(group[order]) != 0]
        # the groups are fewer than 0.75 n, so the gain always suffices
        stop = int(np.searchsorted(np.cumsum(~first), need - rare)) + 1
        for g in np.unique(group[:stop]):
            member = tail[:stop][group[:stop] == g]
            i, j = np.triu_indices(len(member), 1)
            out.append(mix(member[i] * U64(3) + mix(member[j]) + U64(level)))
    sig = np.concatenate(out)
    return sig, np.r_[n - np.arange(rare), np.full(len(sig) - rare, n - rare)].astype(np.int32)


COLUMNS = ["sig", "entity", "n", "most"]
ENTRY = "sig long, entity long, n int, most int"


def _index(docs: DataFrame, codes, frequent: int) -> DataFrame:
    """(sig, entity, n, most), each entity once a batch at most."""

    def run(batches):
        for batch in batches:
            for _, _, sets in _sets(batch, "text"):
                seen, sig, ids, sizes, most = set(), [], [], [], []
                for s in sets:
                    e = entity(s)
                    if len(s) and e not in seen:
                        seen.add(e)
                        found = signatures(s, codes.value, frequent)
                        sig.append(found[0])
                        most.append(found[1])
                        ids.append(np.full(len(sig[-1]), e, np.int64))
                        sizes.append(np.full(len(sig[-1]), len(s), np.int32))
                if sig:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(sig).astype(np.int64)), pa.array(np.concatenate(ids)),
                         pa.array(np.concatenate(sizes)), pa.array(np.concatenate(most))], names=COLUMNS)

    return docs.select("text").mapInArrow(run, ENTRY)


def _shared(batches):
    """Rows of signatures with two entities or more; rows come sorted by (sig, entity)."""
    held = None  # the last different row, whose fate the next batch decides
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy() for c in COLUMNS]
        if held is not None:
            rows = [np.r_[h, x] for h, x in zip(held[0], rows)]
        keep = np.r_[True, (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])]
        rows = [x[keep] for x in rows]
        same = rows[0][1:] == rows[0][:-1]
        known = np.r_[held is not None and held[1], same]  # equals the one before
        known[:-1] |= same
        yield pa.RecordBatch.from_arrays([pa.array(x[:-1][known[:-1]]) for x in rows], names=COLUMNS)
        held = [x[-1:] for x in rows], bool(same[-1]) if len(same) else bool(known[0])
    if held is not None and held[1]:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=COLUMNS)


def _entity_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(entity, shingles) of the wanted entities. A Bloom filter of fixed size keeps
    most others out of the shuffle; the join after it is exact."""
    cells = wanted.select(F.shiftrightunsigned("entity", 40).alias("cell")).distinct() \
        .groupBy(F.expr("cell div 8").alias("byte")).agg(F.sum(F.expr("1 << int(cell % 8)")).alias("value"))

    def pack(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column("byte").to_numpy().astype(np.uint32).tobytes()], pa.binary()),
                 pa.array([batch.column("value").to_numpy().astype(np.uint8).tobytes()], pa.binary())], names=["at", "value"])

    seen = np.zeros(1 << 21, np.uint8)
    for row in cells.mapInArrow(pack, "at binary, value binary").collect():  # 10 MB at most, at any size of input
        seen[np.frombuffer(row["at"], np.uint32)] = np.frombuffer(row["value"], np.uint8)
    held = docs.sparkSession.sparkContext.broadcast(seen)

    def run(batches):
        for batch in batches:
            for _, _, sets in _sets(batch, "text"):
                found = {}
                for s in sets:
                    e = entity(s)
                    cell = (e % 2**64) >> 40
                    if len(s) and e not in found and held.value[cell >> 3] >> (cell & 7) & 1:
                        found[e] = s.astype(np.int64)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()),
                                                      pa.array(list(found.values()), pa.list_(pa.int64()))],
                                                     names=["entity", "shingles"])

    sets = docs.select("text").mapInArrow(run, "entity long, shingles array<long>")
    return sets.join(wanted, "entity", "left_semi").groupBy("entity").agg(F.first("shingles").alias("shingles"))


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that link."""
    left = sets.withColumnsRenamed({"entity": "a", "shingles": "sa"})
    right = sets.withColumnsRenamed({"entity": "b", "shingles": "sb"})
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b") \
        .where(100 * both >= 75 * (F.size("sa") + F.size("sb") - both)).select(pairs.columns)


# a linked pair's sizes, and what it shares: 3 / 7 of both sizes together at least
_NEAR = "4 * least(n, m) >= 3 * greatest(n, m) AND 7 * least(most, qost) >= 3 * (n + m)"


def _remaining(left: DataFrame) -> DataFrame:
    """All pairs (a, b, n, m, part, qart) of different parts that share a signature, from
    the entries (sig, entity, n, most, part). A pair meets at every signature that both
    hold. Where both hold one of the few just before it, that is passed over: they meet
    there too. Signatures go by what the set can still share, falling, so a pair that is
    near enough at one is so before it."""
    few = Window.partitionBy("entity").orderBy(F.desc("most"), "sig").rowsBetween(-PASSED, -1)
    left = materialize(left.withColumn("prev", F.collect_list("sig").over(few)), "left")
    other = left.selectExpr("sig", "entity AS b", "n AS m", "most AS qost", "part AS qart", "prev AS qrev")
    return left.withColumnRenamed("entity", "a").join(other, "sig") \
        .where(f"part <> qart AND a < b AND {_NEAR} AND NOT arrays_overlap(prev, qrev)").select("a", "b", "n", "m", "part", "qart")


def _open_entries(left: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The entries of signatures that two parts or more still hold, each with its part, the
    signature's hub (b, m, qost, qart) and ``open``, the pairs of different parts there.
    The hub is the member with the fewest shingles before the signature."""
    if roots is None:
        known = left.withColumn("part", F.col("entity"))
    else:
        known = left.join(roots, left["entity"] == roots["node"], "left") \
            .select(*COLUMNS, F.coalesce("root", "entity").alias("part"))
    known = known.repartition("sig")
    first = F.struct((F.col("n") - F.col("most")).alias("lack"), F.xxhash64("entity").alias("chance"), "entity", "n", "most", "part")
    hubs = known.groupBy("sig", "part").agg(F.count("*").alias("k"), F.min(first).alias("h")).groupBy("sig") \
        .agg(F.expr("(sum(k) * sum(k) - sum(k * k)) div 2").alias("open"), F.min("h").alias("h")).where("open > 0") \
        .selectExpr("sig", "open", "h.entity AS b", "h.n AS m", "h.most AS qost", "h.part AS qart")
    return materialize(known.join(hubs, "sig"), "entries")


def _join_parts(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """Roots (node, root) after the links (part, qart) between parts. A part that is no
    node yet is an entity of its own."""
    tree = components(links.selectExpr("part AS a", "qart AS b"))
    if roots is None:
        return tree
    step = tree.selectExpr("node AS root", "root AS to")
    moved = roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    full = materialize(moved.unionByName(tree.join(roots, "node", "left_anti")), "roots")
    drop_stage(tree)
    return full


def _links(docs: DataFrame, every: DataFrame, codes, frequent: int) -> DataFrame:
    """Roots (node, root) of the entities that link with another."""
    left = materialize(
        _index(docs, codes, frequent).repartition("sig").sortWithinPartitions("sig", "entity")
        .mapInArrow(_shared, ENTRY), "shared")
    entries, roots = left.count(), None
    if entries:
        parities = materialize(every.where("parity IS NOT NULL").groupBy("entity").agg(F.first("parity").alias("parity"))
                               .join(left.select("entity").distinct(), "entity", "left_semi"), "parities")
    before, turn, last = 0, 0, False
    while entries and not last:
        held = _open_entries(left, roots)
        drop_stage(left)
        left = held
        todo = held.where("entity = b").agg(F.sum("open")).first()[0] or 0
        if todo == 0:
            break
        if last := (turn > 0 and (todo <= entries // 16 or todo > 0.9 * before)):
            pairs = _remaining(held.select(*COLUMNS, "part"))
        else:
            pairs = held.withColumnRenamed("entity", "a").where(f"part <> qart AND {_NEAR}")
            left = held.where("entity <> b").select(COLUMNS)  # all others at its signature have met the hub
        pairs = pairs.selectExpr("least(a, b) AS a", "greatest(a, b) AS b", "least(n, m) AS n", "greatest(n, m) AS m",
                                 "if(a < b, part, qart) AS part", "if(a < b, qart, part) AS qart").distinct()
        close = materialize(
            pairs.join(parities.withColumnsRenamed({"entity": "a", "parity": "pa"}), "a")
            .join(parities.withColumnsRenamed({"entity": "b", "parity": "pb"}), "b")
            .mapInArrow(_close, "a long, b long, part long, qart long"), "close")
        sets = materialize(_entity_sets(docs, close.selectExpr("explode(array(a, b)) AS entity").distinct()), "sets")
        links = materialize(_verify(close, sets).select("part", "qart").distinct(), "links")
        old, roots = roots, _join_parts(roots, links)
        for stage in (close, sets, links, *([old] if old is not None else [])):
            drop_stage(stage)
        del old, pairs, close, sets, links
        release(docs.sparkSession)
        before, turn = todo, turn + 1
    for stage in (left, *([parities] if entries else [])):
        drop_stage(stage)
    return docs.sparkSession.range(0).selectExpr("id AS node", "id AS root") if roots is None else roots


def _membership(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, entity, n) per row, and (entity, root, component_id) per entity that is not empty."""
    every = materialize(_describe(docs), "described")
    codes, frequent = _frequency_codes(every)
    roots = _links(docs, every, docs.sparkSession.sparkContext.broadcast(codes), frequent)
    rows = every.where("block IS NULL").select("doc_id", "entity", "n")
    first = rows.where("n > 0").groupBy("entity").agg(F.min("doc_id").alias("first"))
    placed = first.join(roots, first["entity"] == roots["node"], "left") \
        .select("entity", "first", F.coalesce("root", "entity").alias("root"))
    placed = materialize(placed, "placed")
    head = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows, placed.join(head, "root").select("entity", "root", "component_id")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_shingles`` and ``component_id``, the smallest id that
    links reach."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows, parts = _membership(plain)
    full = rows.where("n > 0").join(parts, "entity", "left").select("doc_id", "n", "component_id")
    none = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return full.unionByName(none).select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each component stays, that with the smallest doc_id, with all
    columns. Documents without words all stay. Rows that agree in doc_id and shingle
    set are one document."""
    rows, parts = _membership(docs.select("doc_id", "text"))
    mark, many, key = fresh(docs, "mark", "many", "key")
    none = F.lit(-2 ** 63)
    # of each component the document with its smallest id (null where all are); one id may
    # be the smallest of several components, with a text in each
    keep = rows.where("n > 0").join(parts, "entity").where("doc_id <=> component_id") \
        .groupBy("root").agg(F.min("entity").alias(mark), F.first("component_id").alias("id")) \
        .select(F.coalesce("id", none).alias(key), mark)
    schema = T.StructType([*docs.schema.fields, T.StructField(mark, T.LongType()), T.StructField(many, T.LongType())])

    def run(batches):
        for batch in batches:
            marks, sizes = [], []
            for _, _, sets in _sets(batch, "text"):
                marks += [entity(s) for s in sets]
                sizes += [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(marks, pa.int64()), pa.array(sizes, pa.int64())], names=schema.names)

    marked = docs.mapInArrow(run, schema).withColumn(key, F.coalesce("doc_id", none))
    single = marked.where(F.col(many) > 0).join(keep, [key, mark], "left_semi").dropDuplicates([key, mark])
    return single.select(docs.columns).unionByName(marked.where(F.col(many) == 0).select(docs.columns))
