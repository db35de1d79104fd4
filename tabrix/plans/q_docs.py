"""Registered queries on the second labelled set: documents joined to labels (small,
imbalanced; 20 sources, 4 languages).  The document text is pruned at the scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabrix.operators import encoders as enc
from tabrix.operators import metrics as V
from tabrix.operators import models as G
from tabrix.operators import profile as P
from tabrix.operators import sampling as S
from tabrix.plans.common import rnd
from tabrix.plans.oracle_base import DOCS_CTE
from tabrix.plans.registry import query
from tabrix.sources.fixture import labelled_documents

WD = "WITH " + DOCS_CTE.strip() + "\n"


def docs(spark, sf):
    return labelled_documents(spark, sf)


@query("docs_p5_class_counts", WD + "SELECT quality, count(*) AS n FROM docs GROUP BY quality")
def docs_p5(spark, sf):
    return P.class_counts(docs(spark, sf), "quality")


@query("docs_x1_balance", WD + """
SELECT doc_id, quality FROM (
  SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(concat(CAST(doc_id AS VARCHAR), ':', '42')), doc_id) AS rk
  FROM docs) WHERE rk <= (SELECT min(n) FROM (SELECT count(*) AS n FROM docs GROUP BY quality))""")
def docs_x1(spark, sf):
    """X1 on the imbalanced quality label (undersample to the rare class)."""
    return S.balance(docs(spark, sf).select("doc_id", "quality"), "quality", 42, id_col="doc_id")


@query("docs_g5_class_weights", WD + """
SELECT d.doc_id, d.quality, round((SELECT count(*) FROM docs) / (2.0 * c.n), 6) AS w
FROM docs d JOIN (SELECT quality, count(*) AS n FROM docs GROUP BY quality) c ON d.quality = c.quality""")
def docs_g5(spark, sf):
    d = G.class_weights(docs(spark, sf).select("doc_id", "quality"), "quality", "w")
    return d.select("doc_id", "quality", F.round("w", 6).alias("w"))


@query("docs_e4_target_encode", WD + """, g AS (SELECT avg(toxic) AS gm FROM docs),
e AS (SELECT source AS lvl, (avg(toxic) * count(*) + (SELECT gm FROM g) * 10.0) / (count(*) + 10.0) AS enc
      FROM docs WHERE source IS NOT NULL GROUP BY source)
SELECT d.doc_id, d.source, round(coalesce(e.enc, (SELECT avg(enc) FROM e)), 6) AS source_target_enc
FROM docs d LEFT JOIN e ON d.source = e.lvl""")
def docs_e4(spark, sf):
    """E4 of a 20-level category (rare levels) against the rare ``toxic`` label."""
    d = docs(spark, sf)
    f = enc.TargetEncoder(["source"], "toxic", 10).fit(d)
    out = enc.target_transform(f, d.select("doc_id", "source"), ["source"])
    return out.select("doc_id", "source", rnd("source_target_enc", "source_target_enc"))


@query("docs_e3_frequency", WD + """
SELECT d.doc_id, round(f.freq, 6) AS lang_freq FROM docs d
JOIN (SELECT lang, count(*) / (SELECT count(lang) FROM docs) AS freq FROM docs WHERE lang IS NOT NULL GROUP BY lang) f
ON d.lang = f.lang""")
def docs_e3(spark, sf):
    d = docs(spark, sf)
    f = enc.FrequencyEncoder(["lang"]).fit(d)
    out = enc.frequency_transform(f, d.select("doc_id", "lang"), ["lang"])
    return out.select("doc_id", rnd("lang_freq", "lang_freq"))


@query("docs_v1_auc_by_lang", WD + """, s AS (SELECT lang, quality AS y, n_chars AS p FROM docs WHERE quality IS NOT NULL AND n_chars IS NOT NULL),
g AS (SELECT lang, p, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS neg
      FROM s GROUP BY lang, p),
c AS (SELECT lang, pos, neg, sum(neg) OVER (PARTITION BY lang ORDER BY p ROWS UNBOUNDED PRECEDING) - neg AS below FROM g)
SELECT lang, round(sum(pos * (below + 0.5 * neg)) / nullif(sum(pos) * sum(neg), 0), 6) AS auc FROM c GROUP BY lang""")
def docs_v1(spark, sf):
    """V1 per language: how well document length ranks quality."""
    d = docs(spark, sf).select("lang", F.col("quality").alias("y"), F.col("n_chars").alias("p"))
    return V.auc(d, by=["lang"]).select("lang", rnd("auc", "auc"))
