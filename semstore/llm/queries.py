"""The registered queries of this subpackage, next to SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from semstore.llm import bilinear, licences, manifest, sentences, substrings
from semstore.llm.common import table
from semstore.llm.decontaminate import contamination_report, find_contamination
from semstore.llm.fingerprints import with_edits
from semstore.llm.language import identify
from semstore.llm.pieces import encode
from semstore.llm.pii import find_personal_data
from semstore.llm.quality import quality
from semstore.llm.setsketch import near_duplicates
from semstore.llm.variants import spelling_variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


_SMALL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_SMALL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(ws)) AS n, array_to_string(ws[i : i + least(13, len(ws)) - 1], ' ') AS win
       FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS win
       FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)),
h AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw USING (win)),
p AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query("op10_decontaminate", _DECONTAMINATE)
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_sentencepiece")
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), digest=True)


@query("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@query("op6_near_duplicates")
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


@query("op7_personal_data")
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@query("op9_sentence_spans")
def op9_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.report(sentences.remove_repeated(table(spark, sf_dir, "documents")))


@query("op1_bilinear_scores")
def op1_bilinear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bilinear.score(table(spark, sf_dir, "documents"))


@query("op8_suffix_arrays")
def op8_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(substrings.remove_repeated(table(spark, sf_dir, "documents")))


@query("op2_licences")
def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


#: crc32 in SQL: the table of the 256 remainders, and the fold over the bytes of UTF-8 (of characters up to U+07FF).
_CRC_TABLE = """crc AS (SELECT list(r ORDER BY i) AS crc_table FROM (
    SELECT i, list_reduce(range(8), lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS r FROM range(256) AS t(i)))"""


def _crc32(text: str) -> str:
    octets = "CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [(192 + (unicode(c) >> 6))::BIGINT, (128 + (unicode(c) & 63))::BIGINT] END"
    octets = f"flatten(list_transform(string_split({text}, ''), lambda c: {octets}))"
    return f"xor(list_reduce({octets}, lambda c, o: xor(c >> 8, crc_table[(xor(c, o) & 255) + 1]), 4294967295), 4294967295)"


_VARIANTS = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, run, count(*) AS times
         FROM (SELECT doc_id, unnest(regexp_extract_all({_SMALL}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
         WHERE length(run) >= 6 GROUP BY ALL),
drawn AS (SELECT run, times, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc),
torn AS (SELECT times, CASE WHEN h % 199 = 0 THEN run[1 : (h % length(run))::INT] || run[(h % length(run))::INT + 2 :] ELSE run END AS word FROM drawn),
vocab AS (SELECT word, sum(times)::BIGINT AS n FROM torn WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
holes AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab),
shorter AS (SELECT word, n, i, word[1 : i - 1] AS a, word[i + 1 :] AS b FROM holes),
pairs AS (SELECT DISTINCT x.word, y.word AS near, y.n FROM shorter x JOIN shorter y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
          UNION SELECT x.word, v.word, v.n FROM shorter x JOIN vocab v ON x.a || x.b = v.word
          UNION SELECT v.word, x.word, x.n FROM shorter x JOIN vocab v ON x.a || x.b = v.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n FROM pairs GROUP BY word),
forms AS (SELECT word, vocab.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * vocab.n THEN near END AS form,
                 CASE WHEN near_n >= 5 * vocab.n THEN near_n END AS form_n FROM vocab LEFT JOIN best USING (word)),
ways(word, root) AS (SELECT word, word FROM forms UNION SELECT ways.word, forms.form FROM ways JOIN forms ON forms.word = ways.root WHERE form IS NOT NULL),
roots AS (SELECT ways.word, root FROM ways JOIN forms ON forms.word = ways.root WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""


@query("op11_spelling_variants", _VARIANTS)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def _merkle_sql(height: int) -> str:
    """The audit in SQL, for sources of place most 16**height rows, and as many sources."""

    def leaf(text: str) -> str:
        part = lambda v: f"coalesce(octet_length(encode({v}::VARCHAR)) || ':' || {v}::VARCHAR, '-')"
        return f"sha256({' || '.join(part(v) for v in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    def levels(name: str, nodes: str) -> str:
        # a tree of one node passes through the levels that are left
        out = [f"{name}0 AS ({nodes})"]
        for k in range(height):
            out.append(
                f"{name}{k}runs AS (SELECT tree, place // 16 AS run, list(h ORDER BY place) AS hs, first(many) AS many "
                f"FROM {name}{k} JOIN (SELECT tree, count(*) AS many FROM {name}{k} GROUP BY tree) s USING (tree) GROUP BY tree, place // 16)"
            )
            out.append(f"{name}{k + 1} AS (SELECT tree, run AS place, CASE WHEN many > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {name}{k}runs)")
        return ",\n".join(out)

    def climb(name: str, start: str, tree: str) -> str:
        """Steps over the levels of `name`, adding siblings to proof and folding."""
        out, before = [], start
        for k in range(height):
            left, right = "array_to_string(hs[1 : place % 16], '')", "array_to_string(hs[place % 16 + 2 :], '')"
            out.append(
                f"{name}climb{k} AS (SELECT p.* EXCLUDE (place, proof, folded), place // 16 AS place, CASE WHEN many > 1 THEN proof || {left} || {right} ELSE proof END AS proof, "
                f"CASE WHEN many > 1 THEN sha256({left} || folded || {right}) ELSE folded END AS folded "
                f"FROM {before} p JOIN {name}{k}runs r ON r.tree = p.{tree} AND r.run = p.place // 16)"
            )
            before = f"{name}climb{k}"
        return ",\n".join(out)

    return f"""
WITH {_CRC_TABLE},
leaves AS (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS source_at, {leaf("text")} AS leaf, {_crc32("doc_id::VARCHAR")} % 5 = 0 AS chosen,
                  {leaf(_SMALL.replace("coalesce(text, '')", "text"))} AS small FROM documents, crc),
entered AS (SELECT *, row_number() OVER (PARTITION BY source_at ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
{levels("s", "SELECT source_at AS tree, place, leaf AS h FROM entered")},
{levels("w", f"SELECT 0 AS tree, tree AS place, h FROM s{height}")},
start AS (SELECT doc_id, source_at, leaf, place, '' AS proof, CASE WHEN chosen THEN small ELSE leaf END AS folded, 0 AS whole FROM entered),
{climb("s", "start", "source_at")},
middle AS (SELECT c.* EXCLUDE (place), source_at AS place, t.h AS subroot FROM s{"climb" + str(height - 1)} c JOIN s{height} t ON t.tree = c.source_at),
{climb("w", "middle", "whole")}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
FROM w{"climb" + str(height - 1)} JOIN w{height} ON true
"""


@query("op12_merkle_manifest", _merkle_sql(5))
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audit(table(spark, sf_dir, "documents"))


@query("op13_fingerprints")
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_edits(table(spark, sf_dir, "documents"))
