"""The registered corpus queries, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortwise.llm import (
    ann, bpe, collocations, exact, langid, merkle, minhash, packing, quality, secrets, simhash, substring, suffix,
)
from cohortwise.llm.common import documents


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.substring_dedup(documents(spark, sf_dir)).drop("tie")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_texts(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(documents(spark, sf_dir)).drop("kept", "tie")


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.nearest(vectors, F.col("vec_id") % 20 == 0)


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op8_fm_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.word_dedup(documents(spark, sf_dir)).drop("tie")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(documents(spark, sf_dir)).drop("tie")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(documents(spark, sf_dir)).drop("tie")


QUERIES = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_bpe": op4_bpe,
    "op5_simhash": op5_simhash,
    "op6_ann": op6_ann,
    "op7_langid": op7_langid,
    "op8_fm_dedup": op8_fm_dedup,
    "op9_secrets": op9_secrets,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_collocations": op11_collocations,
    "op12_merkle": op12_merkle,
    "op13_minhash": op13_minhash,
}

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Counts of all phrases, candidates with their worst cut, and those that no longer one takes up.
COLLOCATIONS = f"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
        FROM (SELECT lang, unnest(regexp_split_to_array({LOWERED}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
    grams AS (SELECT lang, unnest(list_transform(range(1, len(w) + 1), lambda i: w[i:i + 2])) AS g FROM pieces),
    counts AS (
        SELECT lang, k, phrase, count(*)::HUGEINT AS f
        FROM (SELECT lang, k, array_to_string(g[1:k], ' ') AS phrase
              FROM (SELECT lang, g, unnest(range(1, len(g) + 1)) AS k FROM grams)) GROUP BY ALL),
    totals AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
    candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10),
    parts AS (
        SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:k], ' ') AS tail
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)),
    cuts AS (
        SELECT p.lang, p.phrase, p.a, l.f AS l, r.f AS r, cut, 1000000 * p.a * p.a // (l.f * r.f) AS score
        FROM parts p JOIN counts l ON l.lang = p.lang AND l.phrase = head JOIN counts r ON r.lang = p.lang AND r.phrase = tail),
    worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    longer AS (
        SELECT lang, phrase, max(a) AS b FROM (
            SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM candidates WHERE k = 3
            UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE k = 3) GROUP BY ALL),
    ranked AS (
        SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, encode(w.phrase)) AS rank
        FROM worst w LEFT JOIN longer o ON o.lang = w.lang AND o.phrase = w.phrase
        WHERE o.b IS NULL OR 100 * o.b < 50 * a)
    SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
    FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    shift = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    step = f"list_reduce(list_concat([xor(crc, b)], range(8)), lambda c, k: {shift})"
    codes = f"list_transform(string_split({text}, ''), lambda x: unicode(x)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda crc, b: {step}), 4294967295)"


def field_sql(column: str, value: str | None = None) -> str:
    value = value or f"{column}::VARCHAR"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({value}) || ':' || {value} END"


def leaf_sql(text: str) -> str:
    parts = [field_sql(c) for c in ("doc_id", "source", "lang", "n_chars")] + [field_sql("text", text)]
    return f"sha256({' || '.join(parts)})"


def tree_sql(name: str, leaves: str) -> str:
    """Levels of a tree, and for each leaf all siblings on its way up."""
    run = "string_agg(h, '' ORDER BY i)"
    return f"""
    {name}_level AS (
        SELECT 0 AS depth, g, i, n, h FROM {leaves}
        UNION ALL
        SELECT depth + 1, g, i // 8, (n + 7) // 8, sha256({run}) FROM {name}_level WHERE n > 1 GROUP BY depth, g, i // 8, n),
    {name}_step AS (
        SELECT l.g, l.i, x.depth,
               coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i < l.i // (8 ** x.depth)::BIGINT), '') AS before,
               coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i > l.i // (8 ** x.depth)::BIGINT), '') AS after
        FROM {leaves} l JOIN {name}_level x
          ON x.g = l.g AND x.n > 1 AND x.i // 8 = l.i // (8 ** (x.depth + 1))::BIGINT
        GROUP BY ALL)"""


MERKLE = f"""
    WITH RECURSIVE leaves AS (
        SELECT doc_id, lang, coalesce('+' || lang, '') AS g,
               row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
               {leaf_sql("text")} AS h,
               CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 3 = 0 THEN {leaf_sql(LOWERED)} ELSE {leaf_sql("text")} END AS now
        FROM documents),
    {tree_sql("one", "leaves")},
    langs AS (
        SELECT '*' AS g, g AS lang, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n, h
        FROM one_level WHERE n = 1),
    {tree_sql("all", "langs")},
    way AS (
        SELECT g, i, depth, before, after FROM one_step
        UNION ALL
        SELECT leaves.g, leaves.i, 1000 + depth, before, after FROM leaves JOIN langs ON langs.lang = leaves.g
        JOIN all_step ON all_step.i = langs.i),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY g, i ORDER BY depth) AS step FROM way),
    fold AS (
        SELECT g, i, 1 AS step, now AS h FROM leaves
        UNION ALL
        SELECT f.g, f.i, f.step + 1, sha256(before || h || after) FROM fold f JOIN numbered USING (g, i, step)),
    proof AS (SELECT g, i, max(step) + 1 AS steps, string_agg(before || after, '' ORDER BY step) AS p FROM numbered GROUP BY ALL)
    SELECT doc_id, leaves.h AS leaf, langs.h AS subroot, root.h AS root, sha256(coalesce(p, '')) AS proof_sha256,
           fold.h AS folded_root, fold.h = root.h AS verified
    FROM leaves JOIN langs ON langs.lang = leaves.g JOIN (SELECT h FROM all_level WHERE n = 1) root ON true
    LEFT JOIN proof ON proof.g = leaves.g AND proof.i = leaves.i
    JOIN fold ON fold.g = leaves.g AND fold.i = leaves.i AND fold.step = coalesce(steps, 1)"""

NEAR = f"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    grams AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') AS gram
        FROM (SELECT *, unnest(range(1, greatest(len(w), 2))) AS i FROM words WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    common AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id
        GROUP BY ALL),
    links AS (
        SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
    reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, min(b)) AS component_id,
           doc_id = least(doc_id, min(b)) AS kept
    FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON a = doc_id GROUP BY doc_id, n"""

SQL = {
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op11_collocations": COLLOCATIONS,
    "op12_merkle": MERKLE,
    "op13_minhash": NEAR,
}
