"""The registered queries of this folder and their independent SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsengine.llm import exact, fingerprints, jaccard, mixture, neighbours, packing, phrases, quality, ranked, sharding, substrings, token_output, toxicity
from tsengine.session import shipped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select(
        "row.doc_id",
        quality.held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select("row.doc_id", quality.held_out("row.doc_id").alias("held_out"), "severity", "grade", "toxic")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeated_passages(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


_WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP3_SQL = f"""with docs as (select doc_id, {_WORDS_SQL} as words from documents),
windows as (select doc_id, s, md5(array_to_string(words[s:s + 19], ' ')) as h
 from (select doc_id, words, unnest(range(1, len(words) - 18)) as s from docs where len(words) >= 20)),
later as (select doc_id, s from (select doc_id, s, row_number() over (partition by h order by doc_id, s) as n from windows) where n > 1),
gone as (select distinct doc_id, unnest(range(s, s + 20)) as p from later),
numbered as (select doc_id, unnest(words) as w, unnest(range(1, len(words) + 1)) as p from docs),
kept as (select n.doc_id, string_agg(n.w, ' ' order by n.p) as t, count(*) as k from numbered n anti join gone g on g.doc_id = n.doc_id and g.p = n.p group by 1)
select d.doc_id, cast(len(words) as bigint) as n_words, cast(len(words) - coalesce(k, 0) as bigint) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from docs d left join kept using (doc_id)"""


def op4_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


OP4_SQL = f"""with recursive docs as (select doc_id, cast(strlen(coalesce(text, '')) as bigint) as n_bytes,
 lpad(bin(cast(concat('0x', substr(md5(cast(doc_id as varchar)), 1, 16)) as ubigint)), 64, '0') as bits from documents),
root as (select case when sum(n_bytes) > {sharding.SHARD_BYTES} then cast(ceil(log2(sum(n_bytes) / {sharding.SHARD_BYTES})) as int) else 0 end as depth from docs),
levels as (select d.*, r.depth, sum(n_bytes) over (partition by substr(bits, 1, r.depth)) as shard_bytes, count(*) over (partition by substr(bits, 1, r.depth)) as shard_rows from docs d, root r
 union all select doc_id, n_bytes, bits, depth + 1, sum(n_bytes) over (partition by substr(bits, 1, depth + 1)), count(*) over (partition by substr(bits, 1, depth + 1))
 from levels where shard_bytes > {sharding.SHARD_BYTES} and shard_rows > 1)
select doc_id, n_bytes, substr(bits, 1, depth) as shard, depth, cast(shard_bytes as bigint) as shard_bytes, shard_rows
from levels where shard_bytes <= {sharding.SHARD_BYTES} or shard_rows = 1"""


#: Target weights of the registered mixture; sources share alike.
MIXTURE = mixture.Mixture({"domain": {"web": 0.6, "curated": 0.4}, "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}})


def source_domain(source: str = "source") -> Column:
    """Sources with a one-digit number are the web crawl, the others curated."""
    return F.when(F.length(source) <= 4, F.lit("web")).otherwise(F.lit("curated"))


def op5_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixture.mix_sources(table(spark, sf_dir, "documents"), MIXTURE, source_domain())
    return out.select("row.doc_id", *mixture.LEVELS, "tokens", "epoch")


def _budget_sql(level: str, parents: list[str], above: str) -> str:
    """CTEs that share budgets out among the children of ``parents``."""
    keys = ", ".join([*parents, level])
    part = f"partition by {', '.join(parents)}" if parents else ""
    weight = "case " + level + "".join(f" when '{v}' then {w}" for v, w in MIXTURE.weights.get(level, {}).items()) + f" else {MIXTURE.other} end" if level in MIXTURE.weights else f"{MIXTURE.other}"
    join = f"join {above} p using ({', '.join(parents)})" if parents else f"cross join {above} p"
    return f"""{level}_in as (select c.*, p.budget as parent_budget from (select {keys}, sum(tokens) as tokens, sum(tokens) * {MIXTURE.epochs} as capacity, cast({weight} as double) as weight
 from leaves group by {keys}) c {join}),
{level}_rate as (select *, capacity / weight as ratio, (parent_budget - coalesce(sum(capacity) over (w rows between unbounded preceding and 1 preceding), 0))
 / sum(weight) over (w rows between current row and unbounded following) as rate from {level}_in window w as ({part} order by capacity / weight, {level})),
{level}_out as (select {keys}, tokens, cast(floor(round(case when ratio <= rate then capacity else weight * min(case when ratio > rate then {{'ratio': ratio, 'rate': rate}} end) over ({part or ''}).rate end, 3)) as bigint) as budget from {level}_rate)"""


OP5_SQL = rf"""with docs as (select doc_id, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as tokens,
 case when length(source) <= 4 then 'web' else 'curated' end as domain, lang, source from documents),
leaves as (select domain, lang, source, sum(tokens) as tokens from docs group by all),
root as (select least(floor(sum(tokens) * {MIXTURE.share}), sum(tokens) * {MIXTURE.epochs}) as budget from leaves),
{_budget_sql("domain", [], "root")},
{_budget_sql("lang", ["domain"], "domain_out")},
{_budget_sql("source", ["domain", "lang"], "lang_out")},
plan as (select domain, lang, source, cast(budget // tokens as int) as epochs, budget % tokens as part from source_out where tokens > 0),
keyed as (select d.*, epochs, part, md5(concat_ws(':', '{MIXTURE.seed}', epochs, doc_id)) as k from docs d join plan using (domain, lang, source)),
placed as (select *, coalesce(sum(tokens) over (partition by domain, lang, source order by k rows between unbounded preceding and 1 preceding), 0) as before from keyed)
select doc_id, domain, lang, source, tokens, cast(unnest(range(0, epochs + case when before < part then 1 else 0 end)) as int) as epoch from placed"""


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


OP6_SQL = r"""with recursive docs as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents),
sets as (select doc_id, case when len(words) >= 5 then list_sort(list_distinct(list_transform(range(1, len(words) - 3), lambda i: md5(array_to_string(words[i:i + 4], ' ')))))
 when len(words) > 0 then [md5(array_to_string(words, ' '))] else [] end as s from docs),
classes as (select min(doc_id) as c, s from sets where len(s) > 0 group by s),
tokens as (select c, len(s) as n, unnest(s) as t from classes),
links as (select a.c as x, b.c as y from tokens a join tokens b on a.t = b.t and a.c < b.c group by a.c, b.c, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
edges as (select x, y from links union all select y, x from links),
reach as (select c as node, c as other from classes union select r.node, e.y from reach r join edges e on e.x = r.other),
lowest as (select node, min(other) as component from reach group by node)
select d.doc_id, cast(len(d.s) as bigint) as n_shingles, coalesce(l.component, d.doc_id) as component_id
from sets d left join classes k on k.s = d.s left join lowest l on l.node = k.c"""


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.mark_equal_texts(table(spark, sf_dir, "documents"))


OP8_SQL = r"""with docs as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = min(doc_id) over w as kept, sha256(t) as text_sha256
from docs window w as (partition by t)"""


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_output.write_matrices(table(spark, sf_dir, "documents"), vocabulary())
    return out.select("matrix_id", "n_rows", "n_tokens", F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"), "cu_seqlens", "doc_ids", "pieces", "starts")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _terms_sql(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


OP11_SQL = f"""with docs as (select doc_id, {_terms_sql("text")} as t from documents),
totals as (select count(*) as big_n, cast(sum(len(t)) as bigint) as big_l from docs where len(t) > 0),
asked as (select distinct item_id, unnest({_terms_sql("text")}) as w from benchmark),
held as (select doc_id, n, w, count(*) as tf from (select doc_id, len(t) as n, unnest(t) as w from docs) where w in (select w from asked) group by all),
weights as (select w, cast(floor(1000 * ln(cast(2 * big_n + 2 as double) / (2 * df + 1))) as bigint) as weight from (select w, count(*) as df from held group by w), totals),
scored as (select item_id, doc_id, cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // big_l)))) as bigint) as score
 from asked join weights using (w) join held using (w), totals group by all),
ranked as (select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score from scored where score > 0)
select * from ranked where rank <= 10"""


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.best_collocations(phrases.collocations(table(spark, sf_dir, "documents")))


OP12_SQL = r"""with pieces as (select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
spoken as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces),
totals as (select lang, cast(sum(len(words)) as bigint) as n from spoken group by lang),
grams as (select lang, k, words[s:s + k - 1] as p from (select lang, k, words, unnest(range(1, len(words) - k + 2)) as s from spoken, (values (1), (2), (3)) sizes(k))),
counted as (select lang, k, p, count(*) as a from grams group by all having count(*) >= 10),
cuts as (select c.lang, c.k, c.p, c.a, c.cut, l.a as l, r.a as r, cast(1000000 as hugeint) * c.a * c.a // (cast(l.a as hugeint) * r.a) as score
 from (select *, unnest(range(1, k)) as cut from counted where k > 1) c join counted l on l.lang = c.lang and l.p = c.p[1:c.cut] join counted r on r.lang = c.lang and r.p = c.p[c.cut + 1:]),
least_cut as (select * from (select *, row_number() over (partition by lang, p order by score, cut) as o from cuts) where o = 1),
around as (select lang, p, max(a) as most from (select lang, p[1:2] as p, a from counted where k = 3 union all select lang, p[2:3], a from counted where k = 3) group by all),
kept as (select c.* from least_cut c left join around o on o.lang = c.lang and o.p = c.p where o.most is null or 100 * o.most < 50 * c.a),
ranked as (select lang, row_number() over (partition by lang order by score desc, a desc, array_to_string(p, ' ')) as rank, array_to_string(p, ' ') as phrase, a, l, r, cast(score as bigint) as score from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000"""


def op13_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_toxicity": op2_toxicity,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_extendible_sharding": op4_extendible_sharding,
    "op5_source_mixture": op5_source_mixture,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_token_output": op10_token_output,
    "op11_ranked_search": op11_ranked_search,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_order_minhash": op13_order_minhash,
}
QUERIES = {name: shipped(run) for name, run in QUERIES.items()}
ORACLES = {
    "op3_substring_dedup": OP3_SQL,
    "op4_extendible_sharding": OP4_SQL,
    "op5_source_mixture": OP5_SQL,
    "op6_ngram_jaccard_join": OP6_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op11_ranked_search": OP11_SQL,
    "op12_phrase_collocations": OP12_SQL,
}
