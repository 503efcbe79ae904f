"""The subpackage's registered queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL where it exists."""

from __future__ import annotations

from . import common as C
from .bpe import encode_digest
from .decontaminate import leaks
from .exact_dedup import exact_dedup
from .hard_negatives import hard_negatives
from .katz import katz_scores
from .kd_shards import kd_shards
from .ngram_join import ngram_components
from .para_dedup import repeated_passages
from .pu_quality import quality
from .subvector_clusters import subvector_clusters
from .superminhash import near_duplicates
from .toxicity import toxicity
from .warc import round_trip

# Words and 5-word shingles in DuckDB: w is the list of lower-cased words.
LOWER = f"translate(coalesce(text, ''), '{C.UPPER}', '{C.UPPER.lower()}')"
WORDS = f"list_filter(regexp_split_to_array({LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


def op1_bpe(spark, sf_dir):
    return encode_digest(C.table(spark, sf_dir, "documents"), C.vocabulary("byte_bpe_50k.json"))


def op2_decontaminate(spark, sf_dir):
    return leaks(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))


def op3_katz(spark, sf_dir):
    return katz_scores(C.table(spark, sf_dir, "documents"))


def op4_warc(spark, sf_dir):
    return round_trip(C.table(spark, sf_dir, "pages"))


def op5_kd_shards(spark, sf_dir):
    return kd_shards(C.table(spark, sf_dir, "documents"), shards=8)


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup(C.table(spark, sf_dir, "documents"))


def op7_ngram_join(spark, sf_dir):
    return ngram_components(C.table(spark, sf_dir, "documents"))


def op8_toxicity(spark, sf_dir):
    return toxicity(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))


def op9_para_dedup(spark, sf_dir):
    return repeated_passages(C.table(spark, sf_dir, "documents"))


def op10_pu_quality(spark, sf_dir):
    return quality(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark, sf_dir):
    return hard_negatives(C.table(spark, sf_dir, "embeddings"))


def op12_superminhash(spark, sf_dir):
    return near_duplicates(C.table(spark, sf_dir, "documents"))


def op13_subvector_clusters(spark, sf_dir):
    return subvector_clusters(C.table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_decontaminate": op2_decontaminate,
    "op3_katz": op3_katz,
    "op4_warc": op4_warc,
    "op5_kd_shards": op5_kd_shards,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_ngram_join": op7_ngram_join,
    "op8_toxicity": op8_toxicity,
    "op9_para_dedup": op9_para_dedup,
    "op10_pu_quality": op10_pu_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_superminhash": op12_superminhash,
    "op13_subvector_clusters": op13_subvector_clusters,
}

FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _clusters_sql(rounds: int = 3) -> str:
    """Plain k-means over (vector, dimension, value) rows, one set of CTEs a round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""s{r} AS (SELECT f.vec_id, c.j, sum((f.x - c.x) * (f.x - c.x))::BIGINT AS distance
                FROM f JOIN c{r} c USING (d) GROUP BY f.vec_id, c.j),
        a{r} AS (SELECT vec_id, j, distance FROM s{r}
                 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, j) = 1)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT j, d, sum(f.x)::BIGINT AS t, count(*)::BIGINT AS n
                                    FROM a{r} JOIN f USING (vec_id) GROUP BY j, d),
        c{r + 1} AS (SELECT c.j, c.d, CASE WHEN n IS NULL THEN c.x ELSE (t - ((t % n) + n) % n) // n END AS x
                     FROM c{r} c LEFT JOIN m{r} USING (j, d))""")
    return f"""
        WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
                   FROM embeddings WHERE len(embedding) = 64 AND {FINITE}),
        f AS (SELECT vec_id, unnest(range(64)) AS d, unnest(v) AS x FROM e),
        p AS (SELECT vec_id, v FROM e ORDER BY sha256('1:' || vec_id) LIMIT 16),
        k AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS j, v FROM p),
        c0 AS (SELECT j, unnest(range(64)) AS d, unnest(v) AS x FROM k),
        {",".join(steps)},
        h AS (SELECT j, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY j)
        SELECT vec_id, j::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY j)::BIGINT AS cluster_inertia,
               sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256 FROM a{rounds} JOIN h USING (j)"""


ORACLE = {
    "op2_decontaminate": f"""
        WITH iw AS MATERIALIZED (SELECT row_number() OVER () AS item, item_id, {WORDS} AS w FROM benchmark),
        ish AS (SELECT DISTINCT item, item_id, least(len(w), 5) AS n,
                       unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2),
                                             lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS shingle
                FROM iw WHERE len(w) > 0),
        q AS (SELECT item, item_id, count(*) AS item_shingles FROM ish GROUP BY item, item_id),
        dw AS MATERIALIZED (SELECT row_number() OVER () AS doc, doc_id, {WORDS} AS w
               FROM (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents)),
        dsh AS (SELECT DISTINCT doc, doc_id, n, unnest(list_transform(range(1, len(w) - n + 2),
                                                  lambda i: array_to_string(w[i:i + n - 1], ' '))) AS shingle
                FROM dw, (SELECT DISTINCT n FROM ish) WHERE len(w) >= n),
        m AS (SELECT doc, doc_id, item, count(*) AS matched FROM dsh JOIN ish USING (n, shingle) GROUP BY ALL)
        SELECT doc_id, item_id, item_shingles, matched, matched / item_shingles AS containment
        FROM m JOIN q USING (item) WHERE matched >= 0.75 * item_shingles""",
    "op4_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keep, count(*) OVER (PARTITION BY html) AS n,
                     row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST) AS place FROM p)
        SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN strlen(html) >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN strlen(html) >= 1000 AND place > 1 THEN keep END AS refers_to
        FROM g""",
    "op6_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({LOWER}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               text_sha256
        FROM d""",
    "op7_ngram_join": f"""
        WITH RECURSIVE dw AS (SELECT doc_id, {WORDS} AS w FROM documents),
        sh AS (SELECT DISTINCT doc_id, unnest(
                   CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
               FROM dw),
        n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
              FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
        l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
        r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id
        FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.a = d.doc_id
        GROUP BY d.doc_id, n.n""",
    "op11_hard_negatives": f"""
        WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
                   FROM embeddings WHERE label IS NOT NULL AND {FINITE}),
        s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_inner_product(a.v, b.v)::BIGINT AS score
              FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
               s.vec_id AS negative_id, positive_score, s.score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE s.label <> s.own AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
        QUALIFY rank <= 10""",
    "op13_subvector_clusters": _clusters_sql(),
}


def _near_sql(width: int, percent: int) -> str:
    """(doc_id, n_shingles, component_id) by all pairs that share a shingle and a recursive closure."""
    return f"""
        WITH RECURSIVE dw AS (SELECT doc_id, {WORDS} AS w FROM documents),
        sh AS (SELECT DISTINCT doc_id, unnest(
                   CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
                        ELSE list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' '))
                   END) AS s
               FROM dw),
        n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
              FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
        l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
              WHERE 100 * c >= {percent} * (x.n + y.n - c)),
        r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id
        FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.a = d.doc_id
        GROUP BY d.doc_id, n.n"""


ORACLE["op12_superminhash"] = f"SELECT *, doc_id = component_id AS kept FROM ({_near_sql(2, 80)})"
