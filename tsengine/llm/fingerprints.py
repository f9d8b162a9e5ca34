"""Operator 13: Order MinHash fingerprints of documents, sensitive to edit distance. DataFrame functions only."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Components of a fingerprint (at most 48: more aggregates leave generated code), and tokens of a k-mer.
COMPONENTS = 48
TOKENS = 3
#: A token is a run of at most 12 characters with the blanks after it, so the tokens of a text are the whole text.
TOKEN = "[^\\x20\\x09-\\x0D]{1,12}[\\x20\\x09-\\x0D]{0,4}|[\\x20\\x09-\\x0D]{1,4}"
#: Bytes of text in a chunk of documents and in a partition of chunks, and chunks at most; beyond 64 GB the chunks grow.
_CHUNK_BYTES = 1 << 20
_PARTITION_BYTES = 4 << 20
_CHUNKS = 1 << 16
#: Ranges of ids that quantiles find at most, each cut into even parts; one comparison step of the search for a range.
_RANGES = 1 << 12
_STEP = 64
#: Bits of a selected k-mer's place in its text; k-mers beyond the last share it.
_PLACE_BITS = 24
_LOWEST = -(2**63)


def edited(text: Column, following: Column, n: Column) -> Column:
    """The last ``floor(n / 2)`` of the ``n`` characters of ``text`` replaced by the first as many of ``following``, or all."""
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, (n - half).cast("int")), F.left(following, half))


def _chunk(key: Column, own: Column, bounds: list[int], lowest: int, highest: int, split: int) -> Column:
    """Number of the range of ``(key, own)``; an id that several bounds name is told apart by the hash ``own``."""
    ends = F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>")
    coarse = F.array(*[F.lit(b) for b in bounds[_STEP - 1 :: _STEP]]).cast("array<bigint>")
    skipped = F.size(F.filter(coarse, lambda b: b < key)) * _STEP
    at = skipped + F.size(F.filter(F.slice(ends, skipped + 1, _STEP), lambda b: b < key))
    within = F.lit(0)
    if split > 1:
        edges = F.array(*[F.lit(float(b)) for b in (lowest, *bounds, highest)])
        low, high = F.get(edges, at), F.get(edges, at + 1)
        within = F.least(F.greatest(F.floor((key - low) / F.greatest(high - low, F.lit(1.0)) * split), F.lit(0)), F.lit(split - 1))
    share = own / F.lit(2.0**64) + 0.5
    number = at * split + within
    for b, held in sorted(Counter(bounds).items()):
        if held > 1:
            number = F.when(key == b, at * split + F.floor(share * (held * split))).otherwise(number)
    return number.cast("int")


def _in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(chunk, place, copy, id, text, following)``: documents in the order of ids, each with the text of the next.

    Chunks are ranges of ids. Each also gets a copy of the row that follows its last one, so one shuffle brings neighbours together;
    the last chunk gets the first row of all.
    """
    id_, text = F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(id_.alias("id"), F.coalesce(id_.cast("bigint"), F.lit(_LOWEST)).alias("key"), F.xxhash64(text).alias("own"), text.alias("text"))
    size, lowest, highest = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.min("key"), F.max("key")).first()
    chunks = min(max(1, math.ceil(size / _CHUNK_BYTES)), _CHUNKS)
    ranges = min(chunks, _RANGES)
    bounds = []
    if ranges > 1:
        bounds = rows.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)], 20 * _RANGES)).first()[0]
    chunk = _chunk(F.col("key"), F.col("own"), bounds, lowest or 0, highest or 0, math.ceil(chunks / ranges))
    rows = rows.withColumn("chunk", chunk)
    # One row per chunk: at most 65,536 of them, so a window over all and a broadcast are bounded.
    firsts = rows.groupBy("chunk").agg(F.min(F.struct("key", "own")).alias("first"))
    number = Window.partitionBy(F.lit(0)).orderBy("chunk")
    back = F.coalesce(F.lag("chunk").over(number), F.last("chunk").over(number.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    firsts = firsts.select(F.col("chunk").alias("of"), "first.*", back.alias("back")).toDF("of", "first_key", "first_own", "back")
    met = rows.join(F.broadcast(firsts), F.expr("chunk = of and key = first_key and own = first_own"), "left")
    place = F.array(F.struct("chunk", F.lit(False).alias("copy")), F.struct(F.col("back").alias("chunk"), F.lit(True).alias("copy")))
    dealt = met.select("id", "key", "own", "text", F.inline(F.when(F.col("back").isNull(), F.slice(place, 1, 1)).otherwise(place)))
    dealt = dealt.repartition(max(1, math.ceil(size / _PARTITION_BYTES)), "chunk")
    # The id decides nothing here; it keeps the columns of all uses alike, so that the texts are shuffled once.
    order = Window.partitionBy("chunk").orderBy("copy", "key", "own", "text", "id")
    return dealt.select("chunk", F.row_number().over(order).alias("place"), "copy", "id", "text", F.coalesce(F.lead("text").over(order), F.lit("")).alias("following"))


def order_minhash(texts: DataFrame, keys: list[str], text_col: str, components: int = COMPONENTS, tokens: int = TOKENS) -> DataFrame:
    """``keys`` and ``components``, an array of 32-bit numbers, of each text; ``keys`` tell the texts apart.

    The k-mers of a text are its runs of ``tokens`` tokens (a shorter or empty text is one), numbered by occurrence, so that repeated ones differ.
    Component ``j`` deals the numbered k-mers into two classes by bit ``j`` of their hash, selects the minimum of each class under
    its own order, and hashes the two selected k-mers in the order they have in the text. Two texts agree in a component if they share both minima and their order.
    """
    if not 1 <= components <= COMPONENTS:
        raise ValueError(f"components must lie between 1 and {COMPONENTS}")
    found = texts.select(*keys, F.regexp_extract_all(text_col, F.lit(TOKEN), F.lit(0)).alias("token"))
    n = F.greatest(F.size("token") - (tokens - 1), F.lit(1))
    runs = F.arrays_zip(*[F.slice("token", F.lit(i + 1), n).alias(f"t{i}") for i in range(tokens)])
    rows = found.select(*keys, F.posexplode_outer(runs).alias("place_in_text", "run"))
    rows = rows.select(*keys, F.coalesce("place_in_text", F.lit(0)).alias("place_in_text"), F.xxhash64(*[F.col("run")[f"t{i}"] for i in range(tokens)]).alias("kmer"))
    occurrence = F.row_number().over(Window.partitionBy(*keys, "kmer").orderBy("place_in_text"))
    mask = (1 << _PLACE_BITS) - 1
    rows = rows.select(*keys, F.least("place_in_text", F.lit(mask)).cast("bigint").alias("at"), F.xxhash64("kmer", occurrence).alias("h"))
    selected = []
    for j in range(components):
        value = F.xxhash64(F.lit(j), "h").bitwiseAND(F.lit(~mask)).bitwiseOR(F.col("at"))
        for side in (0, 1):
            chosen = F.col("h").bitwiseAND(F.lit(1 << j)) == F.lit(side << j)
            selected.append(F.min(F.when(chosen, value)).alias(f"m{j}_{side}"))
    minima = rows.groupBy(*keys).agg(*selected)

    def component(j: int) -> Column:
        a, b = F.col(f"m{j}_0"), F.col(f"m{j}_1")
        x, y = F.shiftright(a, _PLACE_BITS), F.shiftright(b, _PLACE_BITS)
        first = F.coalesce(a.bitwiseAND(F.lit(mask)) <= b.bitwiseAND(F.lit(mask)), F.lit(True))
        return F.shiftright(F.xxhash64(F.lit(j), F.when(first, x).otherwise(y), F.when(first, y).otherwise(x), first), 32).cast("int")

    return minima.select(*keys, F.array(*[component(j) for j in range(components)]).alias("components"))


def likeness(a: Column, b: Column, components: int = COMPONENTS) -> Column:
    """Share of equal components."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(components))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", components: int = COMPONENTS, tokens: int = TOKENS) -> DataFrame:
    """Per document: id, ``n_chars``, the hash of its edited text, fingerprints of both, and their likeness to it and to the next document.

    The edited text ends in the beginning of the next document (see ``edited``), in ascending order of ids; after the last comes the first, and a lone document
    follows itself. Rows that share an id are in the order of their texts' hashes. A null id comes first. A null text is an empty one; all empty texts have one fingerprint.
    Other columns are not read. An empty table gives an empty table.
    """
    keys = ["chunk", "place", "which"]
    ordered = _in_order(docs, id_col, text_col)
    n = F.length("text")
    changed = edited(F.col("text"), F.col("following"), n)
    both = F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), changed.alias("t")))
    texts = ordered.select("chunk", "place", F.inline(F.when(F.col("copy"), F.slice(both, 1, 1)).otherwise(both)))
    signed = order_minhash(texts, keys, "t", components, tokens)
    pairs = signed.groupBy("chunk", "place").agg(*[F.first(F.when(F.col("which") == w, F.col("components")), ignorenulls=True).alias(f"c{w}") for w in (0, 1)])
    # Neighbours are still in one partition here: the next document's components need no shuffle of their own.
    pairs = pairs.withColumn("following", F.lead("c0").over(Window.partitionBy("chunk").orderBy("place")))
    facts = ordered.where(~F.col("copy")).select("chunk", "place", "id", n.cast("bigint").alias("n_chars"), F.sha2(changed, 256).alias("edited_sha256"))
    rows = facts.join(pairs, ["chunk", "place"])

    def text(c: str) -> Column:
        return F.array_join(F.transform(c, lambda x: F.lpad(F.hex(x.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")

    return rows.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        text("c0").alias("fingerprint"),
        text("c1").alias("edited_fingerprint"),
        likeness(F.col("c0"), F.col("c1"), components).alias("near_edited"),
        likeness(F.col("c0"), F.col("following"), components).alias("near_next"),
    )
