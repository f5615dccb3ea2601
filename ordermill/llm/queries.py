"""The registered queries of the corpus operators, with the SQL twins of those SQL can express.

Each query applies its operator with production parameters to the whole of its table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import (
    bbit_minhash,
    bloom_lm,
    decontaminate,
    html_text,
    jaccard_join,
    line_quality,
    packing,
    periodic_runs,
    site_lines,
    token_files,
    tokenizer_alignment,
    toxicity,
    url_filter,
)
from ordermill.session import work_folder


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _remainder(column: str = "doc_id"):
    """crc32 of the id as text, mod 5."""
    return F.crc32(F.col(column).cast("string")) % 5


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join(read(spark, folder, "documents"))


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(read(spark, folder, "pages"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    model = toxicity.fit(documents, labels.where(_remainder() != 0))
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", F.coalesce(_remainder() == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    return line_quality.judge(documents, line_quality.fit(documents, labels)).drop("labels")


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = site_lines.drop_boilerplate(read(spark, folder, "documents"), least_pages=1, dropped="n_dropped")
    return cleaned.select("doc_id", "source", "text", "n_dropped")


def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.matches(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "covered", "coverage")


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(read(spark, folder, "pages"))


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return bloom_lm.score(read(spark, folder, "documents"), _remainder() == 1)


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = work_folder(spark, "token-files")
    token_files.write(read(spark, folder, "documents"), path)
    return token_files.read(spark, path, with_ids=False)


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """Documents of which every tenth, by crc32 of its id, goes on periodically from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = documents.withColumn("_hash", F.floor(h / 10)).withColumn(
        "_words", F.when(h % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    )
    n = F.size("_words").cast("long")
    placed = chosen.withColumn("_from", F.when(n > 0, F.col("_hash") % n)).withColumn(
        "_period", F.when(n > 0, 1 + F.floor((n - F.col("_from")) / (3 + F.col("_hash") % 8)))
    )
    planted = F.expr(
        "array_join(transform(sequence(0L, size(_words) - 1L), i -> _words[int("
        "if(i < _from, i, _from + (i - _from) % _period))]), ' ')"
    )
    return placed.select("doc_id", F.when(F.col("_period").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.find(with_planted_runs(read(spark, folder, "documents").select("doc_id", "text")))
    longest = F.expr(
        "array_max(transform(runs, r -> named_struct('length', r.length, 'start', -r.start, 'period', -r.period)))"
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = found.withColumn("_best", longest)
    length, period = F.col("_best.length"), -F.col("_best.period")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def op12_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return bbit_minhash.near_duplicates(read(spark, folder, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found = tokenizer_alignment.align(
        read(spark, folder, "documents"), groups=lambda g: F.when(g == "", "").otherwise(F.sha2(g, 256))
    )
    return found.withColumnRenamed("groups", "groups_sha256")


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_ngram_jaccard_join, op2_html_extraction, op3_toxicity, op4_quality_rules, op5_best_fit_packing,
            op6_line_dedup, op7_benchmark_decontamination, op8_url_filters, op9_lm_scoring, op10_token_files,
            op11_periodic_runs, op12_minhash_near_dedup, op13_tokenizer_alignment, pipeline,
        )
    }


OP6 = r"""
WITH pages AS (SELECT row_number() OVER () AS page, doc_id, source, text FROM documents),
totals AS (SELECT source, count(*) AS total FROM pages WHERE text IS NOT NULL GROUP BY source),
numbered AS (
    SELECT page, source, unnest(string_split(text, chr(10))) AS line,
           unnest(range(len(string_split(text, chr(10))))) AS nth
    FROM pages WHERE text IS NOT NULL
),
trimmed AS (
    SELECT *, trim(line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS bare FROM numbered
),
boilerplate AS (
    SELECT l.source, l.bare FROM trimmed l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
    WHERE l.bare <> '' GROUP BY l.source, l.bare, t.total
    HAVING count(DISTINCT l.page) >= 5 AND count(DISTINCT l.page)::DOUBLE / t.total > 0.01
),
judged AS (
    SELECT n.page, count(*) FILTER (WHERE b.bare IS NOT NULL) AS n,
           string_agg(n.line, chr(10) ORDER BY n.nth) FILTER (WHERE b.bare IS NULL) AS left_text
    FROM trimmed n LEFT JOIN boilerplate b ON n.source IS NOT DISTINCT FROM b.source AND n.bare = b.bare
    GROUP BY n.page
)
SELECT d.doc_id, d.source,
       CASE WHEN j.n > 0 THEN coalesce(j.left_text, '') ELSE d.text END AS text,
       coalesce(j.n, 0)::INTEGER AS n_dropped
FROM pages d LEFT JOIN judged j USING (page)
"""


def oracle_sql() -> dict[str, str]:
    """Twins over whole tables. The other operators learn, pack, code or search in ways SQL does not
    express; their tests hold them against brute force, round trips and held-out accuracy."""
    return {"op6_line_dedup": OP6}
