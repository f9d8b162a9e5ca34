"""Operator 6: all links of documents whose word shingles are similar, through a token-group matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.llm import chunks
from tsengine.llm.components import connected_components
from tsengine.session import materialize

WORDS = 5
#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Documents in a group at most, and shingles (unless one document has more).
GROUP_DOCS = 64
_GROUP_TOKENS = 200_000
#: Documents of one label in a row from which they get groups of their own.
_PURE = 16

_SETS = "id bigint, chunk int, n_shingles bigint, node binary"
_BLOBS = "bucket int, chunk int, hashes binary, counts binary"
_REPLY = "chunk int, hashes binary, ranks binary, node binary"
_DOCS = "node binary, n bigint, tokens array<bigint>, probe array<bigint>, index array<bigint>, common bigint, least bigint"
_GROUPS = (
    "gid bigint, nums array<bigint>, labels array<bigint>, ns array<bigint>, sizes array<int>, tokens array<bigint>,"
    " probe array<bigint>, index array<bigint>, low bigint, high bigint, links array<struct<a:bigint,b:bigint>>"
)
_GROUP_NAMES = ["gid", "nums", "labels", "ns", "sizes", "tokens", "probe", "index", "low", "high", "links"]
_LINKS = "a bigint, b bigint"


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Ascending hashes of the distinct shingles: A-Z lower-cased, words between ASCII white space; fewer words than a shingle has are one."""
    parts = text.lower().split()
    return np.unique(chunks.window_hashes(parts, min(words, len(parts)))) if parts else np.empty(0, np.uint64)


def _node(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _sign(places: chunks.Chunks, words: int):
    def sign(batches):
        for batch in batches:
            for s in chunks.pieces(batch.column(1)):
                ids, texts = batch.column(0)[s], chunks.texts_of(batch.column(1)[s])
                signed = [(len(found), _node(found)) for found in (shingles(t, words) for t in texts)]
                yield pa.record_batch(
                    {
                        "id": ids,
                        "chunk": pa.array(places.of(ids, texts), pa.int32()),
                        "n_shingles": pa.array([n for n, _ in signed], pa.int64()),
                        "node": pa.array([node for _, node in signed], pa.binary()),
                    }
                )

    return chunks.released(sign)


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct values and how often each comes, 255 at most; sorts ``values`` where they are."""
    values.sort()
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(values)), bool), values[1:] != values[:-1])))
    counts = np.minimum(np.diff(first, append=len(values)), 255).astype(np.uint8)
    return values[first], counts


def _emit(places: chunks.Chunks, words: int):
    def emit(batches):
        for batch in batches:
            # The shingles of a piece are one array: many small ones that stay would scatter over the heap.
            found: dict[int, list[np.ndarray]] = {}
            for s in chunks.pieces(batch.column(1)):
                texts = chunks.texts_of(batch.column(1)[s])
                for number, rows in chunks.runs(places.of(batch.column(0)[s], texts)):
                    found.setdefault(number, []).append(np.concatenate([shingles(texts[i], words) for i in rows.tolist()]))
            texts = batch = None
            for number in sorted(found):
                values, counts = _counted(np.concatenate(found.pop(number)))
                parts = [(b, chunks.pack(values[s]), counts[s].tobytes()) for b, s in chunks.by_bucket(values, places.buckets)]
                del values, counts
                yield pa.record_batch(
                    {
                        "bucket": pa.array([p[0] for p in parts], pa.int32()),
                        "chunk": pa.array([number] * len(parts), pa.int32()),
                        "hashes": pa.array([p[1] for p in parts], pa.binary()),
                        "counts": pa.array([p[2] for p in parts], pa.binary()),
                    }
                )
                del parts

    return chunks.released(emit)


def _shared(table: pa.Table) -> pa.Table:
    """Of one bucket: for each chunk its shingles that more than one document holds, each with a rank of how many hold it."""
    parts = [chunks.unpack(memoryview(b.as_buffer())) for b in table["hashes"]]
    counts = np.concatenate([np.frombuffer(b.as_buffer(), np.uint8) for b in table["counts"]])
    chunk = np.repeat(np.array(table["chunk"].to_pylist(), np.int32), [len(p) for p in parts])
    values = np.concatenate(parts)
    del parts
    order = np.argsort(values, kind="stable")
    values, counts, chunk = values[order], counts[order], chunk[order]
    del order
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    total = np.add.reduceat(counts, first, dtype=np.int64)
    rank = np.minimum(255, 8 * np.log2(total)).astype(np.uint8)
    held = np.diff(np.append(first, len(values)))
    keep = np.repeat(total > 1, held)
    values, chunk, ranks = values[keep], chunk[keep], np.repeat(rank, held)[keep]
    del counts, first, total, rank, held, keep
    order = np.argsort(chunk, kind="stable")
    values, chunk, ranks = values[order], chunk[order], ranks[order]
    del order
    out = []
    for number, rows in zip(*np.unique(chunk, return_index=True), strict=True):
        end = np.searchsorted(chunk, number, side="right")
        own, at = np.unique(values[rows:end], return_index=True)
        out.append((int(number), chunks.pack(own), ranks[rows:end][at].tobytes()))
    columns = list(zip(*out, strict=True)) or [()] * 3
    return pa.table({"chunk": pa.array(columns[0], pa.int32()), "hashes": pa.array(columns[1], pa.binary()), "ranks": pa.array(columns[2], pa.binary()), "node": pa.nulls(len(out), pa.binary())})


def _candidates(words: int, percent: int):
    """Of one chunk: the documents that can have a partner, with their shared shingles."""

    def pick(documents: pa.Table, reply: pa.Table) -> pa.Table:
        docs = chunks.read_documents(documents["payload"])
        seen = set(reply["node"].to_pylist())  # classes that an earlier chunk stands for
        blobs = [(chunks.unpack(memoryview(h.as_buffer())), np.frombuffer(r.as_buffer(), np.uint8)) for h, r in zip(reply["hashes"], reply["ranks"], strict=True) if h.is_valid]
        blobs.sort(key=lambda b: int(b[0][0]))  # each of its own range of hashes
        known = np.concatenate([b[0] for b in blobs] or [np.empty(0, np.uint64)])
        ranks = np.concatenate([b[1] for b in blobs] or [np.empty(0, np.uint8)])
        del blobs
        rows = {c.split()[0]: [] for c in _DOCS.split(", ")}
        for text in chunks.each_text(docs["text"]) if len(known) else ():
            full = shingles(text, words)
            node = _node(full)
            if not len(full) or node in seen:
                continue
            seen.add(node)
            at = np.minimum(np.searchsorted(known, full), len(known) - 1)
            shared = known[at] == full
            tokens, rank, n = full[shared], ranks[at[shared]], len(full)
            alone, least = n - len(tokens), -(-percent * n // 100)
            if len(tokens) < least:  # all other documents together overlap too little
                continue
            rarest = tokens[np.lexsort((tokens, rank))]
            # Shingles of no other document come first in the order. A partner that is not larger overlaps in ``least`` at
            # least, one that is not smaller in ``larger``: two such sets share one of the rarest of each.
            larger = -(-2 * percent * n // (100 + percent))
            rows["node"].append(node)
            rows["n"].append(n)
            rows["tokens"].append(tokens.view(np.int64))
            rows["probe"].append(rarest[: max(0, n - least + 1 - alone)].view(np.int64))
            rows["index"].append(rarest[: max(0, n - larger + 1 - alone)].view(np.int64))
            rows["common"].append(int(rarest[-1:].view(np.int64)[0]))
            rows["least"].append(int(chunks.mix(tokens).min() >> np.uint64(1)))
        lists = pa.list_(pa.int64())
        types = [pa.binary(), pa.int64(), lists, lists, lists, pa.int64(), pa.int64()]
        return pa.table({name: pa.array(rows[name], t) for name, t in zip(rows, types, strict=True)})

    return chunks.released_pair(pick)


def _numbered(batches):
    """Adds ``num``: documents of a task count on from its number, in their order."""
    at = TaskContext.get().partitionId() << 32
    for batch in batches:
        num = pa.array(np.arange(at, at + batch.num_rows, dtype=np.int64))
        at += batch.num_rows
        yield pa.record_batch([num, *batch.columns], ["num", *batch.schema.names])


def _forest(a: list[int], b: list[int], labels: dict[int, int]) -> list[tuple[int, int]]:
    """Of the links ``(a, b)`` as many as join documents whose labels are not joined yet."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(a, b, strict=True):
        p, q = find(labels[x]), find(labels[y])
        if p != q:
            root[p] = q
            out.append((x, y))
    return out


def _matrix(tokens: np.ndarray, sizes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Documents x ``vocabulary``, 1 where a document has the token."""
    out = np.zeros((len(sizes), len(vocabulary)), np.float32)
    if len(vocabulary):
        at = np.minimum(np.searchsorted(vocabulary, tokens), len(vocabulary) - 1)
        has = vocabulary[at] == tokens
        out[np.repeat(np.arange(len(sizes)), sizes)[has], at[has]] = 1
    return out


def _similar(common: np.ndarray, q_n: np.ndarray, s_n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    common = common.astype(np.int64)
    return np.nonzero(100 * common >= percent * (q_n[:, None] + s_n[None, :] - common))


def _form(percent: int, most: int):
    """Documents in order ``(num, label, n, tokens, probe, index)`` to groups of neighbours, with the links inside each group.

    A run of one label, if long, has groups of its own, so groups that are joined already are known by their label.
    """

    def form(batches):
        gid = TaskContext.get().partitionId() << 32
        mixed, run = [], []

        def written(docs: list[tuple]):
            nonlocal gid
            gid += 1
            nums, labels, ns = ([d[k] for d in docs] for k in range(3))
            sizes, tokens = np.array([len(d[3]) for d in docs]), np.concatenate([d[3] for d in docs])
            m = _matrix(tokens, sizes, np.unique(tokens))
            q, s = _similar(m @ m.T, np.array(ns), np.array(ns), percent)
            upper = q < s
            number = np.array(nums)
            links = _forest(number[q[upper]].tolist(), number[s[upper]].tolist(), dict(zip(nums, labels, strict=True)))
            values = (gid, nums, labels, ns, sizes, tokens, *[np.unique(np.concatenate([d[k] for d in docs])) for k in (4, 5)], min(labels), max(labels), [{"a": x, "b": y} for x, y in links])
            lists = pa.list_(pa.int64())
            pairs = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            types = [pa.int64(), lists, lists, lists, pa.list_(pa.int32()), lists, lists, lists, pa.int64(), pa.int64(), pairs]
            return pa.record_batch([pa.array([v], t) for v, t in zip(values, types, strict=True)], _GROUP_NAMES)

        def full(docs: list[tuple]) -> bool:
            return len(docs) >= most or sum(len(d[3]) for d in docs) >= _GROUP_TOKENS

        for batch in batches:
            flat = [(c.values.to_numpy(), c.offsets.to_numpy()) for c in batch.columns[3:]]
            for i, (num, label, n) in enumerate(zip(*[c.to_pylist() for c in batch.columns[:3]], strict=True)):
                doc = (num, label, n, *[values[ends[i] : ends[i + 1]].copy() for values, ends in flat])
                if run and (run[-1][1] != label or full(run)):
                    if len(run) >= _PURE or full(run):
                        yield written(run)
                    else:
                        mixed += run
                    run = []
                if full(mixed):
                    yield written(mixed)
                    mixed = []
                run.append(doc)
        if len(run) >= _PURE:
            yield written(run)
        else:
            mixed += run
        if mixed:
            yield written(mixed)

    return chunks.released(form)


def _open(percent: int):
    """Two groups a row: their documents that overlap enough with the other group's union are compared exactly; links between labels not joined yet."""

    def compare(batches):
        for batch in batches:
            out: list[tuple[int, int]] = []
            for row in range(batch.num_rows):
                sides = []
                for side in (0, 5):
                    sides.append([batch.column(side + k)[row].values.to_numpy() for k in range(5)])
                (q_nums, q_labels, q_n, q_sizes, q_tokens), (s_nums, s_labels, s_n, s_sizes, s_tokens) = sides
                common = np.intersect1d(q_tokens, s_tokens)
                q, s = _matrix(q_tokens, q_sizes, common), _matrix(s_tokens, s_sizes, common)
                # The bound: overlap of a document with the union of the other group.
                q_open = np.flatnonzero(100 * q.sum(axis=1) >= percent * q_n)
                s_open = np.flatnonzero(100 * s.sum(axis=1) >= percent * s_n)
                if not len(q_open) or not len(s_open):
                    continue
                x, y = _similar(q[q_open] @ s[s_open].T, q_n[q_open], s_n[s_open], percent)
                labels = dict(zip([*q_nums.tolist(), *s_nums.tolist()], [*q_labels.tolist(), *s_labels.tolist()], strict=True))
                out += _forest(q_nums[q_open[x]].tolist(), s_nums[s_open[y]].tolist(), labels)
            yield pa.record_batch([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])

    return chunks.released(compare)


def _opened(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links between the groups of ``pairs (q_gid, s_gid)``."""
    fields = ["nums", "labels", "ns", "sizes", "tokens"]
    for side in ("q", "s"):
        pairs = pairs.join(groups.select(F.col("gid").alias(f"{side}_gid"), *[F.col(f).alias(f"{side}_{f}") for f in fields]), f"{side}_gid")
    return pairs.select(*[f"{side}_{f}" for side in ("q", "s") for f in fields]).mapInArrow(_open(percent), _LINKS)


def _inside(groups: DataFrame) -> DataFrame:
    return groups.select(F.inline("links"))


def _labels(docs: DataFrame, percent: int, most: int) -> DataFrame:
    """``(node, label)``: joined documents share a label."""
    parts = chunks.parts_of(docs.sparkSession)
    ordered = docs.repartitionByRange(parts, "common", "least", "node").sortWithinPartitions("common", "least", "node")
    numbered = materialize(ordered.mapInArrow(_numbered, "num bigint, " + _DOCS), "shingle-documents")
    rows = numbered.select("num", F.col("num").alias("label"), "n", "tokens", "probe", "index")
    first = materialize(rows.mapInArrow(_form(percent, most), _GROUPS), "shingle-groups")
    # Each group meets the lowest of the groups that hold one of its tokens, the one it shares most with: this joins most of a large cluster.
    matrix = first.select("gid", F.explode("probe").alias("token"))
    lowest = matrix.groupBy("token").agg(F.min("gid").alias("s_gid"), F.count(F.lit(1)).alias("held")).where("held > 1").select("token", "s_gid")
    met = matrix.join(lowest, "token").where("gid <> s_gid").groupBy("gid", "s_gid").agg(F.count(F.lit(1)).alias("tokens"))
    pairs = met.groupBy(F.col("gid").alias("q_gid")).agg(F.max_by("s_gid", F.struct("tokens", "s_gid")).alias("s_gid"))
    links = materialize(_inside(first).union(_opened(pairs, first, percent)), "shingle-links")
    # Groups anew, those of joined documents apart; then every pair of groups that share a token and are not joined as a whole.
    joined = connected_components(links).withColumnRenamed("node", "num")
    rows = numbered.join(joined, "num", "left").select("num", F.coalesce("component", "num").alias("label"), "n", "tokens", "probe", "index")
    rows = rows.repartitionByRange(parts, "label", "num").sortWithinPartitions("label", "num")
    second = materialize(rows.mapInArrow(_form(percent, most), _GROUPS), "shingle-groups")
    probe, index = (second.select("gid", "low", "high", F.explode(c).alias("token")) for c in ("probe", "index"))
    mixed = probe.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("h"), F.count(F.lit(1)).alias("held")).where("held > 1 and l <> h").select("token")
    asking = probe.join(mixed, "token", "left_semi").select("token", F.col("gid").alias("q_gid"), F.col("low").alias("q_low"), F.col("high").alias("q_high"))
    asked = index.join(mixed, "token", "left_semi").select("token", F.col("gid").alias("s_gid"), F.col("low").alias("s_low"), F.col("high").alias("s_high"))
    apart = F.expr("q_gid <> s_gid and not (q_low = q_high and s_low = s_high and q_low = s_low)")
    pairs = materialize(asking.join(asked, "token").where(apart).select(F.least("q_gid", "s_gid").alias("q_gid"), F.greatest("q_gid", "s_gid").alias("s_gid")).distinct(), "group-pairs")
    links = links.union(materialize(_inside(second).union(_opened(pairs, second, percent)), "shingle-links"))
    joined = connected_components(links).withColumnRenamed("node", "num")
    return numbered.select("num", "node").join(joined, "num", "left").select("node", F.coalesce("component", "num").alias("label"))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, group_docs: int = GROUP_DOCS) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles`` and ``component_id``, the smallest id that links reach.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of ``words``-word shingles; all links count.

    * Equal sets are one class, compared once.
    * The hashes of all sets meet by hash range and each chunk of ids learns which of its shingles others hold, and how common
      they are. A document that shares too few with all others together is done.
    * The rest are sorted by what they share (their commonest shingle, then the least hash) and neighbours form groups of at most
      ``group_docs``. The token-group matrix has a row for each group and token that the rarest-first prefix of a member
      holds; two documents that link share such a token, so groups without one are not met.
    * A document opens another group only if its overlap with the union of the group's tokens reaches the threshold; open groups are compared
      exactly, by the product of their document-token matrices. A first round, one meeting a group, joins most of a large cluster, whose
      documents then form groups that need not meet each other; the second round meets all others.

    Shingles are compared by 64-bit hashes, classes by 128 bits. Null, empty and blank texts have no shingles and link with nothing.
    Fewer words than a shingle has are one shingle. Rows that share an id each give a row. A null id counts as the smallest.
    Other columns are not read.
    """
    places = chunks.chunks_of(docs, id_col, text_col)
    read = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = materialize(read.mapInArrow(_sign(places, words), _SETS), "shingle-sets")
    spread = sets.where("n_shingles > 0").groupBy("node").agg(F.collect_set("chunk").alias("chunks")).where("size(chunks) > 1")
    elsewhere = spread.select("node", F.array_min("chunks").alias("home"), F.explode("chunks").alias("chunk")).where("chunk <> home")
    hashes = read.mapInArrow(_emit(places, words), _BLOBS)
    reply = hashes.groupBy("bucket").applyInArrow(chunks.released_group(_shared), _REPLY)
    reply = reply.union(elsewhere.select("chunk", F.lit(None).cast("binary"), F.lit(None).cast("binary"), "node"))
    dealt = chunks.dealt_documents(docs, id_col, text_col, places)
    docs = dealt.groupBy("chunk").cogroup(reply.groupBy("chunk")).applyInArrow(_candidates(words, percent), _DOCS)
    joined = _labels(materialize(docs, "shingle-candidates"), percent, group_docs)
    smallest = sets.where("n_shingles > 0").groupBy("node").agg(F.min("id").alias("least"))
    classes = materialize(smallest.join(joined, "node", "left"), "shingle-classes")
    merged = classes.where("label is not null").groupBy("label").agg(F.min("least").alias("component"))
    classes = materialize(classes.join(merged, "label", "left").select(F.col("node").alias("class"), F.coalesce("component", "least").alias("component")), "shingle-components")
    out = sets.join(classes, F.expr("node = class and n_shingles > 0"), "left")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each component of links: that of the smallest id. Documents that link with nothing stay."""
    found = similar_documents(docs, id_col, text_col, **how).select(F.col(id_col).alias("id"), "component_id")
    gone = found.where("not (component_id <=> id)").select(F.col("id").alias("gone")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"))
    return rows.join(gone, F.expr("id <=> gone"), "left_anti").select("row.*")
