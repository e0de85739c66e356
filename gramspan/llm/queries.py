"""The registered query of each operator of this package, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramspan.llm.decontaminate import find_leaks
from gramspan.llm.fingerprints import compare_with_next
from gramspan.llm.jaccard import Similarity, near_duplicates
from gramspan.llm.licenses import scan_all
from gramspan.llm.lines import drop_recurring_lines
from gramspan.llm.mixing import mix_sources
from gramspan.llm.packing import pack_documents
from gramspan.llm.quality import classify
from gramspan.llm.repeats import remove_repeats
from gramspan.llm.search import search
from gramspan.llm.suffixes import remove_earlier_strings
from gramspan.llm.warc import archive_round_trip
from gramspan.llm.whitening import whitened_components
from gramspan.sources import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op3_quality(spark, sf):
    return classify(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


@query()
def op5_fingerprints(spark, sf):
    return compare_with_next(read_table(spark, sf, "documents"))


MIX_SQL = """WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 10))::BIGINT // 16 AS bin FROM {docs}),
src AS (
  SELECT source, s, w, 2.0 * s AS cap, (row_number() OVER (ORDER BY 2.0 * s / w, source NULLS LAST)) AS k FROM (
    SELECT source, sum(size)::BIGINT AS s,
      [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS w
    FROM sized GROUP BY source)),
held AS (
  SELECT k, (1.5 * (SELECT sum(s) FROM src) - coalesce(sum(cap) OVER before, 0)) / sum(w) OVER rest AS level, cap / w AS own
  FROM src WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    rest AS (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
fit AS (SELECT coalesce(min(k), 9223372036854775807) AS k0, arg_min(level, k)::DOUBLE AS level FROM held WHERE own > level),
goal AS (
  SELECT source, s, CASE WHEN k < k0 THEN cap ELSE level * w END::DOUBLE AS target FROM src, fit),
need AS (
  SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END AS whole,
    target - CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END * s AS missing FROM goal),
bins AS (
  SELECT source, bin, sum(size) AS held, sum(sum(size)) OVER (PARTITION BY source ORDER BY bin) AS upto
  FROM sized GROUP BY source, bin),
cut AS (
  SELECT n.source, b.bin + CASE WHEN 2 * (missing - (upto - held)) >= held THEN 1 ELSE 0 END AS cut
  FROM need n JOIN bins b ON n.source IS NOT DISTINCT FROM b.source
  WHERE missing > 0 AND upto - held < missing AND upto >= missing)
"""

MIX_COLUMNS = """(n.whole + CASE WHEN d.bin < c.cut THEN 1 ELSE 0 END)::BIGINT"""
MIX_JOINS = """FROM sized d JOIN need n ON d.source IS NOT DISTINCT FROM n.source
  LEFT JOIN cut c ON d.source IS NOT DISTINCT FROM c.source"""


@query(
    MIX_SQL.format(docs="documents")
    + f"SELECT d.doc_id, d.size, n.s AS source_size, n.target, {MIX_COLUMNS} * d.size AS taken {MIX_JOINS}"
)
def op6_mixing(spark, sf):
    mixed = mix_sources(read_table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op7_warc(spark, sf):
    found = archive_round_trip(read_table(spark, sf, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op10_lines(spark, sf):
    kept = drop_recurring_lines(read_table(spark, sf, "documents").select("doc_id", "text"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(text, 256).alias("kept_sha256"))


@query()
def op1_substrings(spark, sf):
    return remove_repeats(read_table(spark, sf, "documents"))


@query()
def op2_suffixes(spark, sf):
    return remove_earlier_strings(read_table(spark, sf, "documents"))


@query()
def op8_jaccard(spark, sf):
    return near_duplicates(read_table(spark, sf, "documents"), Similarity(words=4, percent=85))


@query()
def op4_decontamination(spark, sf):
    return find_leaks(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


@query()
def op9_licenses(spark, sf):
    return scan_all(read_table(spark, sf, "documents"), read_table(spark, sf, "pages"))


@query()
def op11_whitening(spark, sf):
    return whitened_components(read_table(spark, sf, "embeddings"))


TERMS_SQL = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@query(
    f"""WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {TERMS_SQL} AS t FROM documents),
item AS (SELECT row_number() OVER () AS q, item_id, unnest({TERMS_SQL}) AS term FROM benchmark),
asked AS (SELECT q, item_id, term, count(*) AS c FROM item GROUP BY ALL),
total AS (SELECT count(*)::BIGINT AS docs, sum(len(t))::BIGINT AS terms FROM doc WHERE len(t) > 0),
held AS (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM doc),
post AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM held WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM post, total GROUP BY term, docs),
hit AS (
  SELECT q, item_id, r, doc_id,
    sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))))::BIGINT AS score
  FROM post JOIN weight USING (term) JOIN asked USING (term), total GROUP BY q, item_id, r, doc_id),
best AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM hit WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM best WHERE rank <= 10"""
)
def op12_search(spark, sf):
    return search(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


@query()
def op13_packing(spark, sf):
    import public_tokenizers

    packed = pack_documents(read_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )
