"""The operators as registered queries over whole tables, with SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickweave.llm import bpe, chat, licenses, merkle, mixing, neardup, periods, quality, secrets, substrings, suffixes, topk, urls
from tickweave.llm.common import LOWER, UPPER, read_table, text_of, words_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return keep


@query()
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.dedup_bytes(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.dedup_substrings(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def campaign_urls(pages: DataFrame) -> DataFrame:
    """The query's list: canonical addresses of pages that are advertised with a campaign tag in their query string."""
    tagged = pages.filter(F.col("url").contains("utm_source="))
    return tagged.select(urls.canonical(urls.host_of(F.col("url")), urls.path_of(F.col("url"))).alias("u")).filter("u != ''")


_CANONICAL = r"regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(/|\.html)$', '')"
_FITS = " ".join(
    f"WHEN (host = '{r.partition('/')[0]}' OR host LIKE '%.{r.partition('/')[0]}') AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'"
    for r in sorted(URL_RULES, key=lambda r: (-len(r), r))
)
_VERDICTS = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in URL_RULES.items())


@query(rf"""
WITH p AS (SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, CASE {_FITS} END AS rule, {_CANONICAL} AS canonical_url FROM p),
l AS (SELECT DISTINCT canonical_url FROM r WHERE contains(url, 'utm_source=') AND canonical_url != '')
SELECT page_id, host, path, rule, canonical_url, CASE rule {_VERDICTS} ELSE
  CASE WHEN canonical_url IN (SELECT canonical_url FROM l) THEN 'block' ELSE 'allow' END END AS verdict FROM r""")
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return urls.filter_urls(pages, URL_RULES, campaign_urls(pages))


@query(r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
m AS (SELECT *, row_number() OVER w AS n, lag(role) OVER w AS before FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
e AS (SELECT *, length(text) + length(regexp_replace(text, '[^<\[\x10]', '', 'g')) AS text_chars, length(role) + length(regexp_replace(role, '[^<\[\x10\n]', '', 'g')) AS role_chars FROM m)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(text_chars + CASE WHEN before IS NOT DISTINCT FROM role THEN 6 ELSE role_chars + 8 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""")
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user', :said), (-1L, 1L, 'assistant', :said) AS t(conv_id, turn, role, text)", args={"said": said})
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = chat.read_chat(chat.format_chat(rows))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length("masked").cast("long").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query()
def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base"), 256).alias("base_sha256"), "spans", "n_layers", "n_oversize")


@query()
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"))


VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def encoded_digests(docs: DataFrame) -> DataFrame:
    out = bpe.encode_documents(docs, VOCABULARY, public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(read_table(spark, sf_dir, "documents"))


# The mixture: domains by number of the source, weights by name (1 where none is given).
MIX_DOMAINS = ["web", "news", "books"]
MIX_WEIGHTS = {"domain": {"web": 3, "news": 2}, "lang": {"en": 4, "de": 2, "fr": 2}, "source": {"src0": 2, "src7": 3}}


def mix_levels() -> dict:
    number = F.regexp_extract(F.coalesce(F.col("source"), F.lit("")), "^src([0-9]{1,9})$", 1).try_cast("int")
    domain = F.coalesce(F.get(F.array(*map(F.lit, MIX_DOMAINS)), number % 3), F.lit("other"))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def _mix_level_sql(level: str, path: list[str], source: str) -> str:
    """One level of the tree in SQL: what each node is given out of its parent's budget."""
    above = path[:-1]
    weights = " ".join(f"WHEN '{k}' THEN {v}" for k, v in MIX_WEIGHTS[level].items())
    by = f"PARTITION BY {', '.join(above)}" if above else ""
    keys, joined = ", ".join(path), f"USING ({', '.join(above)})" if above else "ON true"
    return f"""
{level}_0 AS (SELECT {keys}, sum(cap)::HUGEINT AS cap, CASE {level} {weights} ELSE 1 END::HUGEINT AS w FROM leaves GROUP BY {keys}),
{level}_1 AS (SELECT *, coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(w) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM {level}_0 JOIN {source} {joined} WHERE cap > 0 WINDOW w AS ({by} ORDER BY cap::DOUBLE / w::DOUBLE, {level})),
{level}_2 AS (SELECT *, cap * rest <= w * (given - before) AS is_full FROM {level}_1),
{level}_3 AS (SELECT {keys}, CASE WHEN is_full THEN cap ELSE w * (given - coalesce(sum(cap) FILTER (WHERE is_full) OVER ({by}), 0)) // sum(w) FILTER (WHERE NOT is_full) OVER ({by}) END AS given FROM {level}_2)"""


@query(rf"""
WITH d AS (SELECT doc_id, coalesce(['web', 'news', 'books'][TRY_CAST(regexp_extract(coalesce(source, ''), '^src([0-9]{{1,9}})$', 1) AS INTEGER) % 3 + 1], 'other') AS domain,
  coalesce(lang, '') AS lang, coalesce(source, '') AS source, md5(coalesce(text, '')) AS t, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::BIGINT AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, 2 * sum(n_tokens)::HUGEINT AS cap FROM d GROUP BY ALL),
root AS (SELECT floor(sum(tokens)::DOUBLE * 0.6)::HUGEINT AS given FROM leaves),
{_mix_level_sql("domain", ["domain"], "root")}, {_mix_level_sql("lang", ["domain", "lang"], "domain_3")}, {_mix_level_sql("source", ["domain", "lang", "source"], "lang_3")},
b AS (SELECT l.*, coalesce(given, 0) AS budget FROM leaves l LEFT JOIN source_3 USING (domain, lang, source)),
e AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs FROM b),
k AS (SELECT doc_id, domain, lang, source, n_tokens, epochs, budget - epochs * tokens AS rest, md5(concat_ws(':', 'mix', (epochs + 1)::VARCHAR, coalesce(doc_id::VARCHAR, ''), t)) AS key FROM d JOIN e USING (domain, lang, source)),
s AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM k)
SELECT doc_id, domain, lang, source, (epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)::BIGINT AS n_epochs FROM s""")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, levels = read_table(spark, sf_dir, "documents"), mix_levels()
    out, taken = mixing.with_copies(docs, levels, mixing.plan(docs, levels, MIX_WEIGHTS, share=0.6))
    return out.select("doc_id", *[F.coalesce(c, F.lit("")).alias(n) for n, c in levels.items()], F.col(taken).alias("n_epochs"))


@query()
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


@query("""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id != c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10""")
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.quantised(read_table(spark, sf_dir, "embeddings"))
    best = topk.top_k(rows, rows.filter(F.col("vec_id") % 100 == 0), k=10)
    beyond = F.raise_error(F.concat(F.lit("score beyond 64 bits: "), "wide_score")).cast("long")  # as the SQL's cast
    return best.select("query_id", "rank", "vec_id", F.when(F.col("wide_score").isNull(), F.col("score")).otherwise(beyond).alias("score"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Documents of which about a tenth, told by a checksum of the id, repeat a stretch of their words to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    docs = docs.select("doc_id", text_of("text").alias("text"), h.alias("_h"), F.floor(h / 10).alias("_g"))
    docs = docs.withColumn("_words", F.when(F.col("_h") % 10 == 0, words_of(F.col("text"))))
    n = F.size("_words")
    docs = docs.withColumn("_a", F.when(n > 0, F.col("_g") % n))
    docs = docs.withColumn("_p", 1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8)))
    a, p = F.col("_a"), F.col("_p")
    told = F.transform("_words", lambda w, i: F.when(i < a, w).otherwise(F.get("_words", (a + (i - a) % p).cast("int"))))
    return docs.select("doc_id", F.when(a.isNotNull(), F.array_join(told, " ")).otherwise(F.col("text")).alias("text"))


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periods.periodic_runs(with_planted_periods(read_table(spark, sf_dir, "documents")))
    told = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = out.withColumn("best", F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("back"), r["start"].alias("start"), r["period"].alias("period")))))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.back")).alias("length"), F.col("best.period").alias("period"),
        F.expr("(-1000 * best.back) div best.period").alias("exponent_milli"), F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# A checksum of the id's digits, bit by bit; sha256 trees and walks up them by recursion.
_CRC = "xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]), lambda y, k: xor(y >> 1, 3988292384::UBIGINT * (y & 1)))), 4294967295::UBIGINT)"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """Nodes by level over ``grp, pos, digest, n``, and the runs of siblings."""
    return f"""
{name}(lvl, grp, pos, digest, n) AS (SELECT 0, grp, pos, digest, n FROM {leaves}
  UNION ALL SELECT lvl + 1, grp, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM {name} WHERE n > 1 GROUP BY lvl, grp, pos // 3, n),
{name}_runs AS (SELECT lvl, grp, pos // 3 AS run, list(digest ORDER BY pos) AS d FROM {name} WHERE n > 1 GROUP BY lvl, grp, pos // 3)"""


def _walk_sql(name: str, tree: str, start: str) -> str:
    """From ``row, grp, pos, sofar, proof`` up a tree; the last step of each row is its root."""
    left, right = "array_to_string(d[1:(w.pos % 3)], '')", "array_to_string(d[(w.pos % 3 + 2):3], '')"
    return f"""
{name}(lvl, rid, grp, pos, sofar, proof) AS (SELECT 0, rid, grp, pos, sofar, proof FROM {start}
  UNION ALL SELECT w.lvl + 1, rid, w.grp, w.pos // 3, sha256({left} || sofar || {right}), proof || {left} || {right}
  FROM {name} w JOIN {tree}_runs r ON r.lvl = w.lvl AND r.run = w.pos // 3 AND r.grp IS NOT DISTINCT FROM w.grp),
{name}_end AS (SELECT rid, max_by(sofar, lvl) AS sofar, max_by(proof, lvl) AS proof FROM {name} GROUP BY rid)"""


@query(f"""
WITH RECURSIVE found AS (SELECT doc_id, source AS grp, {_leaf_sql("text")} AS digest, CASE WHEN {_CRC} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS seen FROM documents),
leaves AS (SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM found),
{_tree_sql("tree", "leaves")},
subroots AS (SELECT grp AS name, digest, true AS grp, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
{_tree_sql("tops", "subroots")},
{_walk_sql("lower_part", "tree", "(SELECT rid, grp, pos, seen AS sofar, '' AS proof FROM leaves)")},
{_walk_sql("upper_part", "tops", '(SELECT l.rid, s.grp, s.pos, e.sofar, e.proof FROM leaves l JOIN lower_part_end e USING (rid) JOIN subroots s ON s.name IS NOT DISTINCT FROM l.grp)')}
SELECT doc_id, l.digest AS leaf, s.digest AS subroot, t.digest AS root, sha256(e.proof) AS proof_sha256, e.sofar AS folded_root, e.sofar = t.digest AS verified
FROM leaves l JOIN upper_part_end e USING (rid) JOIN subroots s ON s.name IS NOT DISTINCT FROM l.grp JOIN tops t ON t.n = 1""")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    fields = ["doc_id", "source", "lang", "n_chars"]
    out = merkle.merkle_manifest(docs, [*map(F.col, fields), F.col("text")], found=[*map(F.col, fields), text])
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_of("path"), 256).alias("proof_sha256"), "folded_root", "verified")


def _license_sql() -> str:
    words = lambda t: f"regexp_extract_all({t}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    half, block = licenses.BLOCK_WORDS // 2, licenses.BLOCK_WORDS
    stands = lambda p: " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(p.split(), 1))
    places = [f"list_filter(range(len(w)), lambda i: {stands(p)})" for p in licenses.PHRASES]
    labels = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{v}' END" for k, v in enumerate(licenses.PHRASES.values()))
    known = ", ".join(f"('{label}', {sorted(set(licenses.template_words(t)))})" for label, t in licenses.TEMPLATES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
w AS (SELECT *, {words("t")} AS w FROM d),
p AS (SELECT id, doc_id, len(w) AS n_words, {", ".join(f"{x} AS p{k}" for k, x in enumerate(places))} FROM w),
b AS (SELECT id, doc_id, n_words, list_concat({", ".join(f"p{k}" for k in range(len(places)))}) AS places, list_filter([{labels}], lambda x: x IS NOT NULL) AS base FROM p),
known(label, has) AS (VALUES {known}),
lines AS (SELECT id, {words("unnest(string_split(t, chr(10)))")} AS w FROM d),
blocks AS (SELECT DISTINCT id, list_distinct(w[{half} * k + 1 : {half} * k + {block}]) AS has FROM
  (SELECT id, w, unnest(range(1 + greatest(0, ceil((len(w) - {block}) / {half}))::BIGINT)) AS k FROM lines)),
m AS (SELECT id, label, len(list_intersect(b.has, k.has)) / len(k.has) AS share FROM blocks b JOIN known k ON 100 * len(list_intersect(b.has, k.has)) >= {licenses.MIN_PCT} * len(k.has)),
best AS (SELECT id, list(label) AS more, max(share) AS share FROM m GROUP BY id)
SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word, list_max(places)::BIGINT AS last_word,
  array_to_string(list_sort(list_distinct(base)), ',') AS base_labels, array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score FROM b LEFT JOIN best USING (id)"""


@query(_license_sql())
def op11_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan_licenses(read_table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})
