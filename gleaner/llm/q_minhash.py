"""Query op5_near_duplicates."""

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm.common import table
from gleaner.llm.minhash import near_duplicates


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word shingles, similarity 0.8 or more, over all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


# All links by a prefix filter: of sets that are alike to 0.8, the rarest fifth and one more of each share an element.
_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM texts
), spread AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), ranked AS (
  SELECT doc_id, n, x, row_number() OVER (PARTITION BY doc_id ORDER BY df, x) AS r FROM spread JOIN (SELECT x, count(*) AS df FROM spread GROUP BY x) USING (x)
), prefixes AS (
  SELECT doc_id, n, x FROM ranked WHERE r <= n - ceil(0.8 * n) + 1
), candidates AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM prefixes a JOIN prefixes b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), counted AS (
  SELECT a, b, len(list_intersect(p.s, q.s)) AS shared, len(p.s) + len(q.s) AS total FROM candidates JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
), links AS (
  SELECT a, b FROM counted WHERE 100 * shared >= 80 * (total - shared)
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT w.b, r.root FROM reach r JOIN ways w ON r.doc_id = w.a
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(root) AS component_id, s.doc_id = min(root) AS kept FROM sets s JOIN reach r ON s.doc_id = r.doc_id GROUP BY s.doc_id, len(s.s)
"""


QUERIES = {"op5_near_duplicates": op5_near_duplicates}
ORACLES = {"op5_near_duplicates": _SQL}
