"""The registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fulltime.llm import conversations, elias_fano, fertility, jaccard_join, merkle, pieces, pii_boost, pitman_yor, ppm_langid, recompression, source_mix, style_tree, vector_forest
from fulltime.llm.common import shared_path, table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document with the public 32k piece model."""
    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for each vector whose id 20 divides."""
    return vector_forest.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 5-word shingle sets have a Jaccard similarity of 0.75 or more."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources mixed at weights 5, 2, 1 to 150% of all words, none above twice its size."""
    return source_mix.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).taken()


def _fold(mod: int) -> Column:
    """crc32 of doc_id as text, modulo; a null doc_id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(mod))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii_boost.digest(docs, pii_boost.fit(docs))


def op6_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document; the seventh whose fold is 2 teaches nothing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("train", _fold(7) != 2)
    return pitman_yor.score(docs).withColumn("held_out", ~F.col("trained")).drop("trained")


def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; the fifth whose fold is 0 teaches nothing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", _fold(5) == 0)
    model = ppm_langid.fit(docs.where(~F.col("held_out")))
    return ppm_langid.predict(docs, model, keep=["doc_id", "held_out"])


def op10_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and tokeniser fertility of every document."""
    return fertility.verdict(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                             keep=["doc_id"])


def op8_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token ids of all documents as shards in the shared folder and read them back."""
    path = shared_path(spark, "op8-shards")
    elias_fano.write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2, path)
    return elias_fano.read_shards(spark.read.parquet(path))


def op9_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return style_tree.main_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of the documents by language; every seventh is checked with one character more than it has."""
    docs = table(spark, sf_dir, "documents")
    more = F.when(F.col("n_chars") < F.lit(2**63 - 1), F.col("n_chars").cast("long") + 1).otherwise(F.lit(-(2**63)))
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    claimed = merkle.leaf([F.when(F.col("n_chars").isNotNull(), more) if i == 3 else c for i, c in enumerate(fields)])
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    rows = docs.select(F.col("lang").alias("g"), F.col("doc_id").alias("id"), merkle.leaf(fields).alias("leaf"),
                       F.when(tampered, claimed).alias("claimed"))
    return merkle.manifest(rows).withColumnRenamed("id", "doc_id")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of damaged conversations and their cheapest repair."""
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))


def op13_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left when 50-word windows that an earlier document has are removed."""
    return recompression.without_repeats(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_forest": op2_forest,
    "op3_jaccard": op3_jaccard,
    "op4_mixing": op4_mixing,
    "op5_pii": op5_pii,
    "op6_pitman_yor": op6_pitman_yor,
    "op7_ppm": op7_ppm,
    "op8_elias_fano": op8_elias_fano,
    "op9_style_tree": op9_style_tree,
    "op10_fertility": op10_fertility,
    "op11_merkle": op11_merkle,
    "op12_conversations": op12_conversations,
    "op13_recompression": op13_recompression,
}

#: DuckDB text of the CRC-32 of a string of ASCII characters.
CRC32 = ("xor(list_reduce([4294967295::UBIGINT] || [ord(x)::UBIGINT FOR x IN string_split({0}, '')], lambda c, b: "
         "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT)")


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _repair_sql() -> str:
    """The cheapest edits row by row: w0 to w3 hold the least way into each state as ten digits of cost and the audit."""

    def step(way: str, cost: str, edit: str) -> str:
        return f"lpad((({way})[1:10]::BIGINT + {cost})::VARCHAR, 10, '0') || ({way})[11:] || '{edit}'"

    def closed(ways: list[str]) -> list[str]:
        """With inserts before the next row: nothing to user to assistant, system to user, user and assistant to each other."""
        user = f"least({ways[2]}, {step(ways[0], '5', 'I')}, {step(ways[1], '5', 'I')}, {step(ways[3], '5', 'I')})"
        both = "least({0}, {1}, {2})".format(ways[3], step(ways[2], "5", "I"), "least(" + step(step(ways[0], "5", "I"), "5", "I") + ", " + step(step(ways[1], "5", "I"), "5", "I") + ")")
        return [ways[0], ways[1], user, both]

    def into(state: int, initial: str, come: list[int]) -> str:
        more = "CASE WHEN fault = 3 THEN 5 ELSE 0 END"
        ways = []
        for p in come:
            keep, name = step(f"c.w{p}", more, "K"), step(f"c.w{p}", f"1 + {more}", "R")
            again = "NULL" if initial == "s" else name
            ways.append(f"CASE WHEN fault IN (1, 2) THEN NULL WHEN initial = '{initial}' THEN {keep} ELSE {again} END")
        return "least(" + ", ".join([step(f"c.w{state}", "2", "D"), *ways]) + ")"

    moved = [step("c.w0", "2", "D"), into(1, "s", [0]), into(2, "u", [0, 1, 3]), into(3, "a", [2])]
    first, after = closed(["'0000000000'", "NULL::VARCHAR", "NULL::VARCHAR", "NULL::VARCHAR"]), closed([f"m{q}" for q in range(4)])
    return f"""
WITH RECURSIVE keyed AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
marked AS (SELECT *, {CRC32.format('k')} % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 0 THEN [] WHEN kind = 3 THEN [0, 1] ELSE [0] END) FROM marked)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(strlen(role) || ':' || role || text)) AS i FROM damaged),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM placed),
judged AS (
  SELECT *, role[1:1] AS initial, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1 WHEN nth > 1 THEN 2
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 3 ELSE 0 END AS fault FROM numbered),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM judged) GROUP BY conv_id),
ways AS (
  SELECT conv_id, 0::BIGINT AS i, {', '.join(f'{w} AS w{q}' for q, w in enumerate(first))} FROM facts
  UNION ALL
  SELECT conv_id, i, {', '.join(f'{w} AS w{q}' for q, w in enumerate(after))} FROM (
    SELECT c.conv_id, j.i, {', '.join(f'{w} AS m{q}' for q, w in enumerate(moved))}
    FROM ways c JOIN judged j ON j.conv_id IS NOT DISTINCT FROM c.conv_id AND j.i = c.i + 1)),
best AS (
  SELECT w.conv_id, least(w0, w3)[1:10]::BIGINT AS cost, least(w0, w3)[11:] AS audit FROM ways w
  JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.i),
letters AS (
  SELECT conv_id, audit[p:p] AS edit, length(replace(audit[1:p], 'I', '')) AS i,
    length(replace(audit[1:p], 'D', '')) AS line FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS p FROM best)),
lines AS (
  SELECT l.conv_id, l.line, CASE WHEN edit = 'K' THEN j.role WHEN (l.line - CASE WHEN s.system THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE j.text END AS line_text
  FROM letters l LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.i = l.i AND edit <> 'I'
  JOIN (SELECT l.conv_id, coalesce(bool_or(l.edit = 'K' AND l.line = 1 AND j.initial = 's'), false) AS system FROM letters l
        LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.i = l.i GROUP BY l.conv_id) s ON s.conv_id IS NOT DISTINCT FROM l.conv_id
  WHERE edit <> 'D'),
mended AS (SELECT conv_id, string_agg(line_text, chr(10) ORDER BY line) AS t FROM lines GROUP BY conv_id)
SELECT o.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated,
  coalesce(f.illegal, 0) AS illegal, coalesce(b.cost, 0) AS cost, coalesce(b.audit, '') AS audit, sha256(coalesce(m.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN mended m ON m.conv_id IS NOT DISTINCT FROM o.conv_id
""".replace("\\\\", "\\")


#: DuckDB SQL of those that SQL can express.
ORACLE: dict[str, str] = {
    "op3_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
linked AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach AS (
  SELECT doc_id AS d, doc_id AS r FROM documents
  UNION SELECT reach.d, linked.b FROM reach JOIN linked ON linked.a = reach.r)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.r) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN reach ON reach.d = w.doc_id GROUP BY w.doc_id, n.n
""",
    "op11_merkle": f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
    CASE WHEN {CRC32.format('doc_id::VARCHAR')} % 7 = 0 THEN {_leaf('n_chars + 1')} ELSE {_leaf('n_chars')} END AS claimed FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM leaves),
nodes AS (
  SELECT g, 0 AS level, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT g, any_value(level) + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2)
  FROM nodes WHERE n > 1 GROUP BY g, pos // 2),
subroots AS (SELECT g, h, level FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, g AS pos, h, (SELECT count(*) FROM subroots) AS n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2)
  FROM tops WHERE n > 1 GROUP BY pos // 2),
roots AS (SELECT h AS root, level FROM tops WHERE n = 1),
steps AS (  -- every node with its sibling, up to the root: levels of the groups' own trees, then those above
  SELECT n.g, false AS above, n.level, n.pos, coalesce(o.h, '') AS sibling FROM nodes n
  LEFT JOIN nodes o ON o.g = n.g AND o.level = n.level AND o.pos = xor(n.pos, 1::BIGINT) WHERE n.n > 1
  UNION ALL
  SELECT -1, true, t.level, t.pos, coalesce(o.h, '') FROM tops t
  LEFT JOIN tops o ON o.level = t.level AND o.pos = xor(t.pos, 1::BIGINT) WHERE t.n > 1),
climb AS (
  SELECT row_number() OVER () AS k, g, g AS low, false AS above, 0 AS level, pos, claimed AS folded, '' AS proof, 0 AS step,
    doc_id, leaf, p.g AS own FROM placed p
  UNION ALL
  SELECT c.k, CASE WHEN up THEN -1 ELSE c.g END, c.low, up, CASE WHEN up AND NOT c.above THEN 1 ELSE c.level + 1 END, s.pos // 2,
    sha256(CASE WHEN s.pos % 2 = 0 THEN c.folded || s.sibling ELSE s.sibling || c.folded END), c.proof || s.sibling, c.step + 1, c.doc_id, c.leaf, c.own
  FROM (SELECT c.*, c.above OR c.level = b.level AS up, b.level AS top FROM climb c JOIN subroots b ON b.g = c.own) c
  JOIN steps s ON s.above = c.up AND s.g = CASE WHEN c.up THEN -1 ELSE c.g END
    AND s.level = CASE WHEN c.up AND NOT c.above THEN 0 ELSE c.level END
    AND s.pos = CASE WHEN c.up AND NOT c.above THEN c.low ELSE c.pos END),
ends AS (SELECT k, max_by(folded, step) AS folded, max_by(proof, step) AS proof,
  any_value(doc_id) AS doc_id, any_value(leaf) AS leaf, any_value(own) AS own FROM climb GROUP BY k)
SELECT e.doc_id, e.leaf, b.h AS subroot, r.root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = r.root AS verified
FROM ends e JOIN subroots b ON b.g = e.own CROSS JOIN roots r
""",
    "op12_conversations": _repair_sql(),
    "op13_recompression": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
earliest AS (SELECT s, min(doc_id) AS low FROM windows GROUP BY s),
gone AS (
  SELECT DISTINCT x.doc_id, unnest(range(x.i, x.i + 50)) AS i FROM windows x JOIN earliest e ON e.s = x.s WHERE e.low < x.doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (
  SELECT k.doc_id, string_agg(k.word, ' ' ORDER BY k.i) AS t
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w) k ANTI JOIN gone g ON g.doc_id = k.doc_id AND g.i = k.i GROUP BY k.doc_id)
SELECT w.doc_id, len(w.ws) AS n_words, coalesce(l.n, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM w LEFT JOIN lost l ON l.doc_id = w.doc_id LEFT JOIN kept k ON k.doc_id = w.doc_id
""",
}
