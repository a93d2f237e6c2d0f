"""The queries over the given tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import conversations, langid, linededup, merkle, mixing, ngramjoin, packing, pii, quality, spelling, substring, tokens, toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql.strip()
        return fn
    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query()
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that windows of 50 words repeat from earlier documents."""
    return substring.repeats(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the byte-level token ids of every document and of their decoding."""
    return tokens.round_trip(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


@query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of 4096 tokens."""
    return packing.packed(documents(spark, sf_dir), vocabulary("word_bpe_49k.json")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query()
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles are alike to 85 %."""
    return ngramjoin.joined(documents(spark, sf_dir))


LINE_RATIO, LINE_PAGES = 0.1, 5


@query(f"""
WITH p AS (
  SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
         string_split(regexp_replace(html, '<[^>]*>', chr(10), 'g'), chr(10)) AS lines
  FROM pages),
own AS (
  SELECT page_id, host, unnest(list_distinct(lines)) AS line FROM p),
full_lines AS (
  SELECT * FROM own WHERE regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g') <> ''),
totals AS (SELECT host, count(*) AS host_pages FROM p GROUP BY host),
counts AS (SELECT host, line, count(*) AS pages FROM full_lines GROUP BY host, line),
bad AS (
  SELECT c.host, c.line FROM counts c JOIN totals t ON c.host = t.host
  WHERE c.pages >= {LINE_PAGES} AND c.pages > t.host_pages * CAST({LINE_RATIO} AS DOUBLE)),
gone AS (
  SELECT f.page_id, list(f.line) AS gone FROM full_lines f JOIN bad b ON f.host = b.host AND f.line = b.line
  GROUP BY f.page_id),
kept AS (
  SELECT p.page_id, p.lines,
         CASE WHEN g.gone IS NULL THEN p.lines ELSE list_filter(p.lines, lambda x: NOT list_contains(g.gone, x)) END AS kept
  FROM p LEFT JOIN gone g ON p.page_id = g.page_id)
SELECT page_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(kept) AS BIGINT) AS n_removed,
       md5(array_to_string(kept, chr(10))) AS kept_md5
FROM kept
""")
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each site, pages grouped by the host of their url."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    lines = F.split(F.regexp_replace("html", "<[^>]*>", "\n"), "\n", -1)
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1)
    out = linededup.drop_site_lines(pages, "page_id", "html", host, lines, LINE_RATIO, LINE_PAGES)
    return out.select("page_id", "n_lines", "n_removed", F.md5("html").alias("kept_md5"))


@query()
def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of every document and of its edited text."""
    return merkle.compared(documents(spark, sf_dir))


@query()
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of personal data in every document."""
    found = pii.personal_data(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "pii")

    def listed(kinds: tuple[str, ...]):
        some = F.filter("pii", lambda x: x["kind"].isin(*kinds))
        return F.array_join(F.transform(some, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")

    def counted(kind: str):
        return F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(counted, pii.BASE), F.sha2(listed(pii.BASE), 256).alias("base_sha256"), listed(pii.KINDS).alias("spans"))


@query()
def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document under word counts and under the mixing model."""
    return mixing.score(documents(spark, sf_dir))


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts, the base rule and the learned verdict for every document."""
    return quality.quality(documents(spark, sf_dir)).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", "p_good")


TOXIC = 0.5


def fold(id_col: str = "doc_id"):
    """Remainder by 5 of the check sum of the id as text; 0 is held out."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labelled rows of the training folds."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").filter(fold() != 0)
    out = toxicity.scored(docs, toxicity.fit(docs.filter(fold() != 0), labels))
    return out.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


@query()
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired text of every damaged conversation."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    damaged = conversations.damaged(given, F.concat(named("conv_id"), F.lit(":"), named("turn")))
    found = conversations.summaries(conversations.repaired(damaged)).withColumnRenamed("conv_id", "id")
    ids = given.select("conv_id").distinct()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *conversations.FAULTS, "illegal", "cost")]
    return ids.join(found, ids["conv_id"].eqNullSafe(found["id"]), "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


@query()
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours, form and root of every word of the documents."""
    return spelling.grouped(spelling.vocabulary(documents(spark, sf_dir))).select("word", "form", "root", "n", "n_near", "form_n")


@query()
def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents of two of three folds."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    other = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3
    model = langid.fit(docs.filter(other != 1))
    return langid.identified(docs.select("doc_id", "text"), model).select(
        "doc_id", (other == 1).alias("held_out"), "lang_pred", "score")
