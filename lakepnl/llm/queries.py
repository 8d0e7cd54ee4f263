"""One registered query for each operator, with the SQL that checks it where SQL can express it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepnl.llm import (
    decontaminate,
    fill_middle,
    hard_negatives,
    line_spread,
    mixing,
    packing,
    pitman_yor,
    quality,
    sanitise,
    simhash,
    templates,
    token_tree,
    url_filter,
)
from lakepnl.llm.text import read_table
from lakepnl.llm.url_filter import Rule

#: Production parameters.
URL_RULES = (
    Rule("com/", "allow"),
    Rule("example.com/en/", "block"),
    Rule("www.example.com/en/", "allow"),
    Rule("net/es/", "block"),
    Rule("net/fr/", "block"),
)
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where a vocabulary file lies on the workers; the operators take any path."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = url_filter.host_path()
    judged = url_filter.apply_rules(
        url_filter.score_urls(pages).withColumn("host", host).withColumn("path", path), URL_RULES
    )
    verdict = F.coalesce("rule_verdict", "url_verdict").alias("verdict")
    return judged.select("page_id", "host", "path", "rule", verdict, "n_strict_terms", "n_soft_terms")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = templates.extract(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", "n_chars")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.overlaps(docs, read_table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    ids = decontaminate.item_ids()
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_spread.without_boilerplate(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "n_lines", "n_removed", "copied", "text")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *counts, "base_failed", "kept")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_held_out(read_table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    trees = token_tree.build(docs, tokenizer_path()).withColumn("edits", token_tree.sample_edits())
    edited = token_tree.apply_edits(trees, tokenizer_path())
    return edited.select("doc_id", "n_before", "n_tokens", "n_units", "n_encoded")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op10_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise.find_spans(read_table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(kind) for kind in sanitise.KINDS],
        F.sha2(sanitise.listed("base_spans"), 256).alias("base_sha256"),
        sanitise.listed("spans").alias("spans"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = fill_middle.restore(found, "output", "form")
    return restored.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_html_extraction": op3_html_extraction,
    "op4_decontamination": op4_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_token_counts": op8_token_counts,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_pii_sanitisation": op10_pii_sanitisation,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_mixing": op12_mixing,
    "op13_fill_in_middle": op13_fill_in_middle,
}


def _case(rules: tuple[Rule, ...], value: str) -> str:
    """The longest rule that fits, in SQL."""
    ordered = sorted(rules, key=lambda r: -len(r.pattern))
    whens = " ".join(
        f"WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}') THEN '{getattr(r, value)}'"
        for r in ordered
    )
    return f"CASE {whens} END"


def _terms(terms: tuple[str, ...]) -> str:
    """How many different terms stand between boundaries, in SQL."""
    found = [rf"regexp_matches(u, '(^|[^\p{{L}}\p{{N}}]){t}($|[^\p{{L}}\p{{N}}])')::BIGINT" for t in terms]
    return reduce(lambda a, b: f"{a} + {b}", found)


_AZ = f"'{url_filter.UPPER}', '{url_filter.LOWER}'"

OP1_SQL = f"""
WITH a AS (
  SELECT page_id, translate(coalesce(url, ''), {_AZ}) AS u, instr(coalesce(url, ''), '://') AS scheme_at,
         coalesce(url, '') AS whole FROM pages
), b AS (
  SELECT page_id, u, CASE WHEN scheme_at > 0 THEN substr(whole, scheme_at + 3) ELSE '' END AS rest FROM a
), c AS (
  SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*', 0), {_AZ}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM b
), d AS (
  SELECT page_id, host, path, {_case(URL_RULES, "pattern")} AS rule, {_case(URL_RULES, "verdict")} AS by_rule,
         {_terms(url_filter.DEFAULT.strict)} AS n_strict_terms, {_terms(url_filter.DEFAULT.soft)} AS n_soft_terms FROM c
)
SELECT page_id, host, path, rule,
       coalesce(by_rule, CASE WHEN n_strict_terms > 0 OR n_soft_terms >= {url_filter.DEFAULT.min_soft}
                              THEN 'block' ELSE 'allow' END) AS verdict,
       n_strict_terms, n_soft_terms
FROM d
"""

OP4_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p
        FROM i WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, p, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
        FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)
), m AS (SELECT dw.doc_id, dw.p, dw.k, iw.item_id FROM dw JOIN iw USING (k, win)
), h AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM m) GROUP BY doc_id
), n AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP5_SQL = rf"""
WITH x AS (
  SELECT doc_id, text, min(coalesce(source, '')) OVER (PARTITION BY coalesce(text, '')) AS site FROM documents
), l AS (
  SELECT doc_id, site, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS p FROM x
), t AS (
  SELECT *, regexp_replace(raw, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line,
         len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS words FROM l
), b AS (
  SELECT line FROM t WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= {line_spread.MIN_SITES}
), m AS (
  SELECT t.*, b.line IS NOT NULL AS hit FROM t LEFT JOIN b USING (line)
), s AS (
  SELECT doc_id, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (hit) AS n_hit,
         100 * sum(CASE WHEN hit THEN words ELSE 0 END) > {line_spread.COPIED_SHARE} * sum(words) AS copied,
         string_agg(raw, chr(10) ORDER BY p) FILTER (NOT hit) AS rest
  FROM m GROUP BY doc_id
)
SELECT s.doc_id, n_lines::BIGINT AS n_lines, n_hit::BIGINT AS n_removed, copied,
       CASE WHEN n_hit = 0 THEN d.text ELSE coalesce(rest, '') END AS text
FROM s JOIN documents d USING (doc_id)
"""

OP11_SQL = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, o.r AS o, o.vec_id AS other_id, a.label = o.label AS same,
         list_dot_product(a.v, o.v)::BIGINT AS score
  FROM e a, e o WHERE a.vec_id % 100 = 0 AND a.r <> o.r
), p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, other_id NULLS LAST) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id,
       row_number() OVER (PARTITION BY p.a, p.o ORDER BY s.score DESC, s.other_id NULLS LAST)::INTEGER AS rank,
       s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.o ORDER BY s.score DESC, s.other_id NULLS LAST) <= 10
"""

OP13_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), c AS (
  SELECT *, len(t) AS n, ('0x' || h[1:8])::BIGINT % (len(t) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(t) + 1) AS c2,
         CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>')
                   OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
), p AS (
  SELECT *, array_to_string(t[1:least(c1, c2)], '') AS a, array_to_string(t[least(c1, c2) + 1:greatest(c1, c2)], '') AS b,
         array_to_string(t[greatest(c1, c2) + 1:], '') AS z FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(a)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(b)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || b
                        ELSE '<S>' || z || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(x) AS restored_sha256
FROM p
"""

ORACLES = {
    "op1_url_filter": OP1_SQL,
    "op4_decontamination": OP4_SQL,
    "op5_line_dedup": OP5_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
