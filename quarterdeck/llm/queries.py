"""The registered queries of the corpus operators, over the whole tables, and their SQL where there is any."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm import decontaminate, fingerprints, langid, language_model, merkle, minmax, mixing, negatives, quality, sampling, sharding, simhash, token_store, toxicity

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_shard_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"shard-{k:05d}" for k in range(sharding.SHARDS)]
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), names)


def op2_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = language_model.score(table(spark, sf_dir, "documents"))
    mean = F.coalesce(F.try_divide("log_score", "n_words"), F.lit(0.0))
    return out.select("doc_id", "n_words", F.round("log_score", 5).alias("log_score"), F.round(mean, 5).alias("score"))


def op2_stupid_backoff_own_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and pairs only, and each document counted with the corpus."""
    out = language_model.score(table(spark, sf_dir, "documents"), orders=2, held_out=False)
    return out.select("doc_id", "n_words", F.round("log_score", 5).alias("log_score"))


def op3_naive_bayes_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = sampling.remainder(F.col("doc_id"), 5)
    out = langid.identify(docs.select("doc_id", "text"), docs.filter(fold != 0))
    return out.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op4_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.encode_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op5_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op6_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = sampling.remainder(F.col("doc_id"), 3)
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold != 1)
    out = toxicity.scored(docs, lexicon).withColumn("score", F.col("toxicity.score"))
    return out.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = sampling.remainder(F.col("doc_id"), 4)
    docs = table(spark, sf_dir, "documents")
    out = quality.scored(docs, table(spark, sf_dir, "labels"), fold != 2)
    return out.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op9_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.copies(table(spark, sf_dir, "documents"))
    return drawn.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    c = F.col("contamination")
    return found.select(
        "doc_id",
        c["n_words"].alias("n_words"),
        c["n_hit"].alias("n_hit"),
        F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", c["items"]), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op11_minmax_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), given=merkle.lowered())


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(negatives.prepared(table(spark, sf_dir, "embeddings"), label=label), F.col("id") % 100 == 0)


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP9_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id AS id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), named AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS source_size,
         CAST([5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS HUGEINT) AS weight
  FROM sized GROUP BY source
), total AS (
  SELECT sum(source_size) AS words, sum(weight) AS weights FROM named
), rounds AS (  -- each round stops the sources whose share of what is left is above three times their size
  SELECT 0 AS k, CAST(0 AS HUGEINT) AS spent, CAST(0 AS HUGEINT) AS gone, CAST(0 AS HUGEINT) AS n
  UNION ALL
  SELECT k + 1, s.spent, s.gone, s.n
  FROM rounds r, LATERAL (
    SELECT CAST(coalesce(sum(3 * source_size), 0) AS HUGEINT) AS spent, CAST(coalesce(sum(weight), 0) AS HUGEINT) AS gone, CAST(count(*) AS HUGEINT) AS n
    FROM named, total
    WHERE 3 * source_size * (weights - r.gone) < (words - r.spent) * weight
  ) s WHERE k = 0 OR s.n > r.n
), final AS (SELECT * FROM rounds ORDER BY k DESC LIMIT 1),
goal AS (
  SELECT source, source_size,
         CASE WHEN 3 * source_size * (weights - gone) < (words - spent) * weight THEN 3 * source_size ELSE (words - spent) * weight END AS num,
         CASE WHEN 3 * source_size * (weights - gone) < (words - spent) * weight THEN 1 ELSE weights - gone END AS den
  FROM named, total, final
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY CAST(floor(sqrt(size)) AS INTEGER),
                ('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8))::BIGINT % 64, size, id) AS HUGEINT) AS k
  FROM sized
), placed AS (
  SELECT r.*, g.source_size, g.num, g.den * g.source_size AS unit,
         (('0x' || substr(md5(coalesce(r.source, '') || ':0'), 1, 8))::HUGEINT * (g.den * g.source_size)) // 4294967296 AS shift,
         CAST(g.num AS DOUBLE) / CAST(g.den AS DOUBLE) AS target
  FROM ranked r JOIN goal g ON r.source IS NOT DISTINCT FROM g.source
)
SELECT id AS doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(coalesce((shift + k * num) // nullif(unit, 0) - (shift + (k - 1) * num) // nullif(unit, 0), 0) AS BIGINT) * size AS taken
FROM placed
"""

OP10_SQL = rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bwin AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + 12), ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM bw WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM bwin),
dwin AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)
), hits AS (SELECT doc_id, i, d.n, item FROM dwin d JOIN bwin b ON d.g = b.g AND d.n = b.n),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP2_OWN_CORPUS_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), pos AS (
  SELECT doc_id, len(w) AS n, i, w[i] AS word, CASE WHEN i > 1 THEN w[i - 1] END AS prev FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w)
), c1 AS (SELECT word, count(*) AS c FROM pos GROUP BY word),
c2 AS (SELECT prev, word, count(*) AS c FROM pos WHERE prev IS NOT NULL GROUP BY prev, word),
total AS (SELECT count(*) AS n FROM pos),
scores AS (
  SELECT p.doc_id, sum(CASE WHEN p.prev IS NULL THEN ln(u.c) - ln(total.n) ELSE ln(c2.c) - ln(v.c) END) AS s
  FROM pos p JOIN c1 u ON p.word = u.word LEFT JOIN c2 ON p.prev = c2.prev AND p.word = c2.word LEFT JOIN c1 v ON p.prev = v.word, total
  GROUP BY p.doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(s, 0), 5) AS log_score FROM w LEFT JOIN scores USING (doc_id)
"""

OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), pos AS (
  SELECT doc_id, len(w) AS n, i, w[i] AS a, CASE WHEN i > 1 THEN w[i - 1] END AS b, CASE WHEN i > 2 THEN w[i - 2] END AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w)
), one AS (SELECT doc_id, a, sum(count(*)) OVER (PARTITION BY a) - count(*) AS k FROM pos GROUP BY doc_id, a),
two AS (SELECT doc_id, b, a, sum(count(*)) OVER (PARTITION BY b, a) - count(*) AS k FROM pos WHERE b IS NOT NULL GROUP BY doc_id, b, a),
three AS (SELECT doc_id, c, b, a, sum(count(*)) OVER (PARTITION BY c, b, a) - count(*) AS k FROM pos WHERE c IS NOT NULL GROUP BY doc_id, c, b, a),
total AS (SELECT count(*) AS n FROM pos),
scores AS (
  SELECT p.doc_id, sum(CASE
    WHEN t.k > 0 THEN ln(nullif(t.k, 0)) - ln(nullif(tv.k, 0))
    WHEN d.k > 0 THEN ln(nullif(d.k, 0)) - ln(nullif(dv.k, 0)) + (least(p.i, 3) - 2) * ln(0.4)
    ELSE ln(greatest(u.k, 1)) - ln(greatest(total.n - p.n, 1)) + (least(p.i, 3) - 1) * ln(0.4) END) AS s
  FROM pos p JOIN one u ON p.doc_id = u.doc_id AND p.a = u.a
  LEFT JOIN two d ON p.doc_id = d.doc_id AND p.b = d.b AND p.a = d.a
  LEFT JOIN one dv ON p.doc_id = dv.doc_id AND p.b = dv.a
  LEFT JOIN three t ON p.doc_id = t.doc_id AND p.c = t.c AND p.b = t.b AND p.a = t.a
  LEFT JOIN two tv ON p.doc_id = tv.doc_id AND p.c = tv.b AND p.b = tv.a, total
  GROUP BY p.doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(s, 0), 5) AS log_score,
       round(coalesce(s / nullif(len(w), 0), 0), 5) AS score FROM w LEFT JOIN scores USING (doc_id)
"""

OP11_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id) p
  JOIN sizes x ON x.doc_id = p.a JOIN sizes y ON y.doc_id = p.b WHERE 100 * k >= 80 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
"""


def _levels_sql(name: str, first: str, levels: int) -> tuple[str, str]:
    """Tables ``name``0, ``name``1, ... of (tree, pos, n, h) from ``first``, each with the hashes of runs of 16 of the one before, and of (tree, run, hs) runs."""
    steps = [f"{name}0 AS ({first})"]
    for k in range(levels):
        steps.append(f"{name}_runs{k} AS (SELECT tree, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM {name}{k} WHERE n > 1 GROUP BY tree, pos // 16)")
        up = f"SELECT r.tree, run AS pos, (t.n + 15) // 16 AS n, sha256(array_to_string(hs, '')) AS h FROM {name}_runs{k} r JOIN (SELECT DISTINCT tree, n FROM {name}{k}) t USING (tree)"
        steps.append(f"{name}{k + 1} AS (SELECT * FROM {name}{k} WHERE n = 1 UNION ALL {up})")
    return ",\n".join(steps), f"{name}{levels}"


def _fold_sql(name: str, levels: int, before: str, tree: str, pos: str) -> tuple[str, str]:
    """Tables that take (id, proof, shown) up the levels of ``name`` from table ``before``, whose ``tree`` and ``pos`` place a row."""
    steps = []
    for k in range(levels):
        j = f"(f.{pos} // {16**k}) % 16"
        left, right = f"coalesce(array_to_string(list_slice(hs, 1, {j}), ''), '')", f"coalesce(array_to_string(list_slice(hs, {j} + 2, 16), ''), '')"
        steps.append(
            f"{name}_fold{k} AS (SELECT f.* REPLACE (CASE WHEN hs IS NULL THEN proof ELSE proof || {left} || {right} END AS proof, CASE WHEN hs IS NULL THEN shown ELSE sha256({left} || shown || {right}) END AS shown) "
            f"FROM {before} f LEFT JOIN {name}_runs{k} r ON r.tree = f.{tree} AND r.run = f.{pos} // {16 ** (k + 1)})"
        )
        before = f"{name}_fold{k}"
    return ",\n".join(steps), before


def _op12_sql(levels: int = 6, top_levels: int = 3) -> str:
    field = lambda c: f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    inner, last = _levels_sql("inner", "SELECT tree, pos, n, h FROM placed", levels)
    outer, top = _levels_sql("outer", f"SELECT 0 AS tree, tree AS pos, (SELECT count(DISTINCT tree) FROM placed) AS n, h FROM {last}", top_levels)
    fold, folded = _fold_sql("inner", levels, "began", "tree", "pos")
    rest, done = _fold_sql("outer", top_levels, folded, "zero", "tree")
    table = ",\n".join(f"c{k} AS (SELECT i, xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END) AS x FROM c{k - 1})" for k in range(1, 9))
    return rf"""
WITH c0 AS (SELECT CAST(range AS BIGINT) AS i, CAST(range AS BIGINT) AS x FROM range(256)),
{table},
crc AS (SELECT list(x ORDER BY i) AS t FROM c8),
hit AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: xor(a >> 8, t[1 + xor(a, b) % 256])), 4294967295) % 5 = 0 AS hit FROM documents, crc
), leaves AS (
  SELECT doc_id, source, {leaf("text")} AS h, {leaf("CASE WHEN hit THEN translate(text, " + _LETTERS + ") ELSE text END")} AS shown FROM hit
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h, shown) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves
), {inner},
{outer},
began AS (SELECT doc_id, h AS leaf, '' AS proof, shown, tree, pos, 0 AS zero FROM placed),
{fold},
{rest}
SELECT f.doc_id, leaf, s.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, shown AS folded_root, shown = t.h AS verified
FROM {done} f JOIN {last} s ON s.tree = f.tree, {top} t
"""


OP12_SQL = _op12_sql()

OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 5
"""

_ALL = (
    op1_shard_lookup,
    op2_stupid_backoff,
    op2_stupid_backoff_own_corpus,
    op3_naive_bayes_language,
    op4_wavelet_tokens,
    op5_weighted_fingerprints,
    op6_toxicity_lexicon,
    op7_simhash_groups,
    op8_quality_fm,
    op9_systematic_mix,
    op10_decontamination,
    op11_minmax_groups,
    op12_merkle_manifest,
    op13_hard_negatives,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {"op2_stupid_backoff": OP2_SQL, "op2_stupid_backoff_own_corpus": OP2_OWN_CORPUS_SQL, "op9_systematic_mix": OP9_SQL, "op10_decontamination": OP10_SQL, "op11_minmax_groups": OP11_SQL, "op12_merkle_manifest": OP12_SQL, "op13_hard_negatives": OP13_SQL}
