"""One query per operator, over whole tables with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusledger.llm import (
    byte_bpe, circulant_minhash, decontaminate, dual_tree, fill_in_middle, html_paths, language_id, license_scan,
    mixing, quality_classifier, quality_rules, secret_owners, virtual_slots,
)
from corpusledger.runtime import scratch_path


#: Words as the contracts have them, for RE2.
WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang")
    narrow = quality_rules.staged(quality_rules.measured(docs).drop("text"), "measured")
    out = quality_rules.judged(narrow)
    return out.select(
        "doc_id", *quality_rules.MEASURES, "base_failed", "kept",
        "lang", "log_perplexity", "lower_band", "upper_band",
    )


def op2_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_paths.extract(_table(spark, sf, "pages"))


def op3_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.license_scan(_table(spark, sf, "documents"))


def op4_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A document stands for a repository, its source for the owner; both numbers decide."""
    return secret_owners.secrets(_table(spark, sf, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    items = _table(spark, sf, "benchmark").select("item_id", "text")
    return decontaminate.contaminated(docs, items)


def op6_virtual_slots(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return virtual_slots.shard_records(docs, scratch_path(spark, "slot-map"))


def op7_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang")
    labels = _table(spark, sf, "labels")
    judged = quality_classifier.classify(docs, labels.where("quality = 1").select("doc_id"))
    return judged.withColumnRenamed("accepted", "kept")


def op8_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.identify(_table(spark, sf, "documents").select("doc_id", "text", "lang"))


def op9_circulant_minhash(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return circulant_minhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


def op10_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


def op11_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    return dual_tree.search(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op12_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return fill_in_middle.digests(fill_in_middle.fill_in_middle(docs))


def op13_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(_table(spark, sf, "documents"), path, public_tokenizers.PATTERN)


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_html_extraction": op2_html_extraction,
    "op3_license_scan": op3_license_scan,
    "op4_secret_scan": op4_secret_scan,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_virtual_slots": op6_virtual_slots,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_language_id": op8_language_id,
    "op9_circulant_minhash": op9_circulant_minhash,
    "op10_source_mixing": op10_source_mixing,
    "op11_ranked_search": op11_ranked_search,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_byte_bpe": op13_byte_bpe,
}

def _spans_sql(kind: str, number: int) -> str:
    """Matches of one kind with their places, from the pieces of text between them."""
    pattern, group, least = secret_owners.PATTERNS[kind]
    quoted = pattern.replace("'", "''")
    more = " AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')" if kind == "token" else ""
    return f"""
      SELECT row, doc_id, owner, {number} AS kind, value,
        (list_sum(list_transform(gaps[1:i], lambda x: length(x)))
          + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start,
        (list_sum(list_transform(gaps[1:i], lambda x: length(x)))
          + list_sum(list_transform(found[1:i], lambda x: length(x))))::BIGINT AS end_
      FROM (
        SELECT row, doc_id, owner, found, gaps, unnest(range(1, len(found) + 1)) AS i,
          unnest(regexp_extract_all(text, '{quoted}', {group})) AS value
        FROM (SELECT *, regexp_extract_all(text, '{quoted}', 0) AS found,
            string_split_regex(text, '{quoted}') AS gaps FROM rows)
        WHERE len(found) > 0)
      WHERE length(value) >= {least}{more}"""


_KIND_NAMES = "[" + ", ".join(f"'{kind}'" for kind in secret_owners.KINDS) + "]"

ORACLES: dict[str, str] = {
    "op10_source_mixing": f"""
      WITH sized AS (
        SELECT doc_id, source,
          len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
          ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 't' || coalesce(text, ''))), 1, 15))::BIGINT AS h
        FROM documents),
      sources AS (
        SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
      weighed AS (
        SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sources),
      ranked AS (
        SELECT *, row_number() OVER r AS place, (sum(source_size) OVER ())::BIGINT AS total,
          coalesce(sum(source_size) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS below,
          (sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS onward
        FROM weighed WINDOW r AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST)),
      limited AS (
        SELECT *, (3 * source_size)::DOUBLE * onward <= (total - 3 * below)::DOUBLE * weight AS stops
        FROM ranked),
      free AS (SELECT * FROM limited WHERE NOT stops ORDER BY place LIMIT 1),
      wanted AS (
        SELECT l.source, l.source_size,
          CASE WHEN l.stops THEN (3 * l.source_size)::DOUBLE
            ELSE (f.total - 3 * f.below)::DOUBLE * l.weight / f.onward END AS target
        FROM limited l LEFT JOIN free f ON true),
      planned AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole,
          target - whole * source_size AS rest FROM wanted),
      hashed AS (SELECT source, h, sum(size)::BIGINT AS words FROM sized GROUP BY source, h),
      summed AS (
        SELECT *, (sum(words) OVER (PARTITION BY source ORDER BY h))::BIGINT AS upto FROM hashed)
      SELECT s.doc_id, s.size, p.source_size, p.target, s.source, (s.size * (p.whole
        + CASE WHEN (u.upto - u.words) + u.upto < 2 * p.rest THEN 1 ELSE 0 END))::BIGINT AS taken
      FROM sized s
      JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
      JOIN summed u ON s.source IS NOT DISTINCT FROM u.source AND s.h = u.h""",
    "op11_ranked_search": f"""
      WITH words AS (
        SELECT doc_id, n, unnest(terms) AS term FROM (SELECT doc_id, terms, len(terms) AS n FROM (
          SELECT doc_id, regexp_extract_all({_LOWERED},
            '{TERM}') AS terms FROM documents))),
      totals AS (SELECT count(DISTINCT doc_id) AS n_docs, count(*) AS n_terms FROM words),
      wanted AS (
        SELECT item_id, term, count(*) AS times FROM (
          SELECT item_id, unnest(regexp_extract_all({_LOWERED}, '{TERM}')) AS term FROM benchmark)
        GROUP BY 1, 2),
      held AS (
        SELECT doc_id, n, term, count(*) AS tf FROM words SEMI JOIN wanted USING (term) GROUP BY 1, 2, 3),
      weighed AS (
        SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
        FROM held, totals GROUP BY term),
      scored AS (
        SELECT item_id, doc_id,
          sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
        FROM held JOIN wanted USING (term) JOIN weighed USING (term), totals GROUP BY 1, 2),
      ranked AS (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
        FROM scored WHERE score > 0)
      SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op12_fill_in_middle": """
      WITH cut AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units,
          sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS hash FROM documents),
      drawn AS (
        SELECT *, len(units) AS n, ('0x' || hash[1:8])::BIGINT % (len(units) + 1) AS one,
          ('0x' || hash[9:16])::BIGINT % (len(units) + 1) AS two, ('0x' || hash[17:24])::BIGINT % 100 AS rate,
          ('0x' || hash[25:32])::BIGINT % 100 AS turn FROM cut),
      parts AS (
        SELECT *, CASE WHEN text = '' OR regexp_matches(text, '<P>|<S>|<M>') OR rate >= 100 THEN 'plain'
            WHEN turn < 50 THEN 'spm' ELSE 'psm' END AS form,
          array_to_string(units[1:least(one, two)], '') AS prefix,
          array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
          array_to_string(units[greatest(one, two) + 1:], '') AS suffix FROM drawn)
      SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
          ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
        sha256(text) AS restored_sha256
      FROM parts""",
    "op4_secret_scan": f"""
      WITH rows AS (
        SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, coalesce('s' || source, '') AS owner
        FROM documents),
      sizes AS (SELECT owner, count(DISTINCT coalesce('d' || doc_id::VARCHAR, '')) AS size FROM rows GROUP BY 1),
      base AS ({" UNION ALL ".join(_spans_sql(kind, i) for i, kind in enumerate(secret_owners.KINDS[:3]))}),
      bare AS (
        SELECT * FROM ({_spans_sql("token", 3)}) t
        WHERE NOT EXISTS (
          SELECT 1 FROM base b WHERE b.row = t.row AND b.start < t.end_ AND t.start < b.end_)),
      all_spans AS (SELECT * FROM base UNION ALL SELECT * FROM bare),
      held AS (
        SELECT value, owner, count(DISTINCT coalesce('d' || doc_id::VARCHAR, '')) AS repositories
        FROM all_spans GROUP BY 1, 2),
      counted AS (
        SELECT value, count(*) AS owners, sum(repositories)::BIGINT AS repositories, sum(size) AS size
        FROM held JOIN sizes USING (owner) GROUP BY value),
      verdicts AS (
        SELECT *, CASE
            WHEN owners >= {secret_owners.COPIED_OWNERS} THEN 'copied'
            WHEN repositories >= {secret_owners.COPIED_REPOSITORIES}
              AND repositories * {secret_owners.SHARE} >= size THEN 'copied'
            WHEN owners = 1 AND repositories < {secret_owners.COPIED_REPOSITORIES}
              AND len(list_distinct(string_split(value, ''))) >= {secret_owners.LEAST_DISTINCT}
              THEN 'live' ELSE 'unclear' END AS verdict
        FROM counted),
      judged AS (SELECT b.*, v.verdict, v.owners, v.repositories FROM all_spans b JOIN verdicts v USING (value)),
      named AS (
        SELECT *, {_KIND_NAMES}[kind + 1] || ':' || start || ':' || end_ AS name FROM judged
        WHERE kind < 3 OR verdict = 'live'),
      per_row AS (
        SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
          count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (kind = 3) AS n_token,
          coalesce(string_agg(name, ',' ORDER BY start, kind) FILTER (kind < 3), '') AS base_spans,
          string_agg(name, ',' ORDER BY start, kind) AS spans,
          count(*) FILTER (kind < 3 AND verdict = 'live') AS n_live,
          count(*) FILTER (kind < 3 AND verdict = 'copied') AS n_copied,
          max(owners) FILTER (kind < 3) AS max_owners, max(repositories) FILTER (kind < 3) AS max_repositories
        FROM named GROUP BY row)
      SELECT r.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
        coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base_spans, '')) AS base_sha256,
        coalesce(spans, '') AS spans, coalesce(n_token, 0) AS n_token, coalesce(n_live, 0) AS n_live,
        coalesce(n_copied, 0) AS n_copied, coalesce(max_owners, 0) AS max_owners,
        coalesce(max_repositories, 0) AS max_repositories
      FROM rows r LEFT JOIN per_row USING (row)""",
    "op9_circulant_minhash": f"""
      WITH RECURSIVE split AS (
        SELECT row_number() OVER (ORDER BY doc_id NULLS LAST) AS row, doc_id,
          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
      shingles AS (
        SELECT DISTINCT row, array_to_string(w[i:i + 4], ' ') AS shingle
        FROM (SELECT row, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM split WHERE len(w) > 0)),
      sizes AS (SELECT row, count(*) AS n FROM shingles GROUP BY 1),
      links AS (
        SELECT a.row AS a, b.row AS b FROM shingles a JOIN shingles b USING (shingle)
        JOIN sizes x ON x.row = a.row JOIN sizes y ON y.row = b.row
        WHERE a.row <> b.row GROUP BY 1, 2, x.n, y.n
        HAVING 100 * count(*) >= {circulant_minhash.PERCENT} * (x.n + y.n - count(*))),
      reached AS (
        SELECT row, row AS root FROM split
        UNION SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.row WHERE r.root < l.b)
      SELECT d.doc_id, coalesce(n, 0) AS n_shingles, r.doc_id AS component_id,
        d.doc_id IS NOT DISTINCT FROM r.doc_id AS kept
      FROM split d LEFT JOIN sizes USING (row)
      JOIN (SELECT row, min(root) AS root FROM reached GROUP BY 1) c USING (row)
      JOIN split r ON r.row = c.root""",
}
