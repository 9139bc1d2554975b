"""The clean build with all four reasons: exact and semantic duplicates, n-gram leakage, embedding leakage."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.operators import clean, exact, vectors
from corpuskit.plans import inputs as I
from corpuskit.plans import text_queries as texts
from corpuskit.plans import vector_queries as vecs
from corpuskit.staging import staged

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


_SETS = (
    f"ex AS (WITH {I.DOCS_SQL}, {texts._hashes('docs')} SELECT row_id FROM (SELECT row_id, row_number() OVER (PARTITION BY l3 ORDER BY row_id) AS n FROM h) WHERE n > 1), "
    f"sem AS (WITH {vecs._GRAPH} SELECT row_id FROM labels JOIN chosen USING (cluster) WHERE row_id <> representative), "
    f"leak AS (WITH {texts._NGRAM} SELECT DISTINCT row_id FROM hits), emb AS (WITH {vecs._FOUND} SELECT DISTINCT dst AS row_id FROM found), "
    "removed AS (" + " UNION ALL ".join(f"SELECT row_id, {k} AS p, '{r}' AS r FROM {t}" for k, (r, t) in enumerate(zip(clean.REASONS, ("ex", "sem", "leak", "emb")), 1)) + ")"
)


def _log(spark, sf_dir):
    """The sets of the four reasons, each written once; vectors are those of the documents with their ids."""
    labels = vecs._labels(spark, sf_dir)
    edges, _ = vecs._cross(spark, sf_dir)
    sets = {
        "exact_duplicate": exact.keep_first(texts._digests(spark, sf_dir), "l3").where("not kept").select("row_id"),
        "semantic_duplicate": vectors.removed(labels, vectors.representatives(labels, vecs._lengths(spark, sf_dir))).select("row_id"),
        "leakage_high_confidence": texts._hits(spark, sf_dir).select("row_id").distinct(),
        "embedding_leakage": vectors.matches(edges, vecs.THRESHOLD).select(F.col("dst").alias("row_id")).distinct(),
    }
    return {r: staged(df, r) for r, df in sets.items()}


@query(f"WITH {_SETS} SELECT row_id, string_agg(r, ',' ORDER BY p) AS reasons FROM removed GROUP BY 1")
def build_log(spark, sf_dir):
    return clean.removal_log(_log(spark, sf_dir)).select("row_id", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {_SETS} SELECT doc_id AS row_id FROM documents WHERE doc_id NOT IN (SELECT row_id FROM removed)")
def build_rows(spark, sf_dir):
    return clean.kept(I.documents(spark, sf_dir), clean.removal_log(_log(spark, sf_dir))).select("row_id")


@query(f"WITH {_SETS} SELECT r AS reason, count(*) AS rows FROM removed GROUP BY 1 UNION ALL SELECT 'unique', count(DISTINCT row_id) FROM removed")
def build_reasons(spark, sf_dir):
    return clean.reason_counts(clean.removal_log(_log(spark, sf_dir)))


@query(
    f"WITH {_SETS}, first AS (SELECT row_id, min(p) AS p FROM removed GROUP BY 1), n AS (SELECT count(*) AS n FROM documents) SELECT 0 AS step, 'source' AS stage, n AS rows FROM n "
    + " ".join(f"UNION ALL SELECT {k}, 'after_{r}', n - (SELECT count(*) FROM first WHERE p <= {k}) FROM n" for k, r in enumerate(clean.REASONS, 1))
)
def build_funnel(spark, sf_dir):
    return clean.funnel(I.documents(spark, sf_dir), _log(spark, sf_dir))
