"""The registered queries of this package: whole tables in, the operators' full results out."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, collocations, exact_dedup, importance, jaccard_join, language_model, licenses, line_dedup, mixing, packing, rabitq, substring_dedup, warc
from .common import bound_batches

QUERIES, SQL = {}, {}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, unless they find it where they start."""
    root = Path(__file__).resolve().parents[2]
    known = [Path(p).resolve() for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p]
    context = spark.sparkContext
    if root not in known and not any(f.endswith("/plantframe.zip") for f in context.listFiles):
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/plantframe", "zip", root, "plantframe"))


def register(run):
    def started(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return run(spark, sf_dir)

    QUERIES[run.__name__] = started
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@register
def op1_importance_resampling(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return importance.resample(table(spark, sf_dir, "documents"), importance.target_ids(labels), share=importance.good_share(labels))


@register
def op2_packing(spark, sf_dir):
    bound_batches(spark)
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer())


@register
def op3_rabitq(spark, sf_dir):
    return rabitq.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@register
def op4_warc(spark, sf_dir):
    folder = warc.archive_folder(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), folder).write.format("noop").mode("overwrite").save()
    return warc.read_archives(spark, folder).drop("url", "payload")


@register
def op5_pseudo_likelihood(spark, sf_dir):
    bound_batches(spark)
    return language_model.score(table(spark, sf_dir, "documents"))


@register
def op6_license_sentences(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


SQL["op6_license_sentences"] = licenses.scan_sql()


@register
def op8_mixing(spark, sf_dir):
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


@register
def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


SQL["op7_exact_dedup"] = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


@register
def op9_line_dedup(spark, sf_dir):
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL["op9_line_dedup"] = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
k AS (SELECT doc_id, i, line,
  translate(regexp_replace(regexp_replace(line, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.doc_id, k.i, k.line, f.key IS NOT NULL AND k.doc_id <> f.first AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@register
def op10_jaccard_join(spark, sf_dir):
    return jaccard_join.similar_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


SQL["op10_jaccard_join"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * p.n >= 80 * (nx.n + ny.n - p.n)),
u AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r AS (SELECT x, x AS y FROM u UNION SELECT r.x, u.y FROM r JOIN u ON r.y = u.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.x = w.doc_id
"""


@register
def op11_token_alignment(spark, sf_dir):
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer(), tokenizer("piece_bpe_32k.model"))


@register
def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


SQL["op12_collocations"] = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY ALL HAVING count(*) >= 100),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, k AS m, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
x AS (SELECT lang, m, phrase, a, ws, unnest(range(1, m)) AS k FROM c),
s AS (
  SELECT x.lang, x.phrase, x.a, x.k, l.n AS l, r.n AS r, t.n, (1000::HUGEINT * x.a * t.n // (l.n::HUGEINT * r.n))::BIGINT AS score
  FROM x JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(x.ws[1:x.k], ' ')
  JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(x.ws[x.k + 1:x.m], ' ') JOIN t ON t.lang = x.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (
  SELECT DISTINCT c.lang, c.phrase FROM c JOIN c o ON o.lang = c.lang AND o.m > c.m AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * o.a >= 100 * c.a),
k AS (SELECT b.* FROM b ANTI JOIN i ON i.lang = b.lang AND i.phrase = b.phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM k QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""


@register
def op13_substring_dedup(spark, sf_dir):
    found = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL["op13_substring_dedup"] = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d WHERE len(words) >= 13)),
f AS (SELECT g, min(doc_id) AS first FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM w JOIN f USING (g) WHERE doc_id > first),
k AS (SELECT d.doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM d)
SELECT d.doc_id, any_value(len(words)) AS n_words, count(c.p) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY k.p) FILTER (k.p IS NOT NULL AND c.p IS NULL), '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = k.doc_id AND c.p = k.p GROUP BY d.doc_id
"""
