"""Catalogue of the pipeline operators' queries, with check SQL where SQL can state the result."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm import ann, decontaminate, dialogue, html, infill, langid, license, lm, neardup, packing, rollup, toxicity, warc
from corpuslens.llm.common import crc_mod, table
from corpuslens.sources.tables import materialize, shared_root

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def sql_words(text: str, kind: str = "alnum") -> str:
    """DuckDB list of the words of a text."""
    lowered = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    inside = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+" if kind == "alnum" else r"[^\x20\x09-\x0D]+"
    return f"regexp_extract_all({lowered}, '{inside}')"


DECONTAMINATE_SQL = f"""
WITH item AS (
  SELECT item_id, {sql_words("text")} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)
), doc AS (
  SELECT doc_id, {sql_words("text")} AS w FROM documents
), place AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (
  SELECT doc_id, i, n, item_id FROM place JOIN windows USING (n, phrase)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), owner AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN owner USING (doc_id)
"""


@query("op1_decontaminate", DECONTAMINATE_SQL)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against all benchmark windows."""
    return decontaminate.digest(decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op10_pack")
def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer_path())


NEAR_SQL = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, {sql_words("text", "space")} AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)
), sized AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), reach(doc_id, other) AS (
  SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), least_id AS (
  SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(other, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(other, d.doc_id) AS kept
FROM doc d LEFT JOIN sized s ON s.doc_id = d.doc_id LEFT JOIN least_id l ON l.doc_id = d.doc_id
"""


@query("op6_neardup", NEAR_SQL)
def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under shingle similarity 0.85."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key", "first")


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a field fitted without the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    value = F.col("toxicity.score")
    return toxicity.score(docs, chain).select(
        "doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), value.alias("score"),
        (value >= toxicity.THRESHOLD).cast("int").alias("predicted"), F.size("toxicity.spans").alias("n_spans"),
    )


@query("op2_main_text")
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html.extract(table(spark, sf_dir, "pages"))


WARC_SQL = """
WITH page AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), named AS (
  SELECT page_id, octet_length(payload) AS size, sha1(payload) AS digest,
    CASE WHEN octet_length(payload) >= 1000 THEN max(page_id) OVER (PARTITION BY payload) ELSE page_id END AS first
  FROM page
)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN first <> page_id OR page_id IS NULL AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id OR page_id IS NULL THEN first END AS refers_to
FROM named
"""


@query("op4_warc", WARC_SQL)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to a content-addressed archive and read back."""
    return warc.read(spark, warc.write(table(spark, sf_dir, "pages"))).drop("url", "payload")


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


LICENSE_SQL = f"""
WITH doc AS (
  SELECT doc_id, {sql_words("text")} AS w, text FROM documents
), phrase(words, label) AS (
  VALUES {", ".join(f"({sql_list(p.split())}, '{label}')" for p, label in license.PHRASES.items())}
), place AS (
  SELECT doc_id, label, unnest(list_filter(range(0, greatest(len(w) - len(words) + 1, 0)), lambda i: w[i + 1:i + len(words)] = words)) AS i
  FROM doc, phrase WHERE list_has_all(w, words)
), base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS named FROM place GROUP BY doc_id
), template(label, words) AS (
  VALUES {", ".join(f"('{label}', {sql_list(sorted(set(t.split())))})" for label, t in license.TEMPLATES)}
), line AS (
  SELECT doc_id, list_distinct({sql_words("line")}) AS tokens FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM doc)
), part AS (
  SELECT doc_id, label, len(list_intersect(words, tokens)) / len(words) AS part FROM line, template
), matched AS (
  SELECT doc_id, list(DISTINCT label) AS more, max(part) AS part FROM part WHERE part >= {license.THRESHOLD} GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  array_to_string(list_sort(coalesce(named, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(named, []), coalesce(more, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0)::DOUBLE END AS score
FROM doc LEFT JOIN base USING (doc_id) LEFT JOIN matched USING (doc_id)
"""


@query("op9_license", LICENSE_SQL)
def op9_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and licence notices in all documents."""
    return license.scan(table(spark, sf_dir, "documents"))


LICENSE_WINDOWS_SQL = f"""
WITH doc AS (
  SELECT doc_id, {sql_words("text")} AS w FROM documents
), phrase(words, label) AS (
  VALUES {", ".join(f"({sql_list(p.split())}, '{label}')" for p, label in license.PHRASES.items())}
), place AS (
  SELECT doc_id, label, unnest(list_filter(range(0, greatest(len(w) - len(words) + 1, 0)), lambda i: w[i + 1:i + len(words)] = words)) AS i
  FROM doc, phrase WHERE list_has_all(w, words)
), base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS named FROM place GROUP BY doc_id
), template(label, words, size) AS (
  VALUES {", ".join(f"('{label}', {sql_list(sorted(set(t.split())))}, {math.ceil(len(t.split()) / license.THRESHOLD - 1e-9)})" for label, t in license.TEMPLATES)}
), possible AS (
  SELECT doc_id, w, label, words, size FROM doc, template WHERE len(list_intersect(words, w)) / len(words) >= {license.THRESHOLD}
), part AS (
  SELECT doc_id, label, len(list_intersect(words, w[i:i + size - 1])) / len(words) AS part
  FROM (SELECT *, unnest(range(1, greatest(len(w) - size, 0) + 2)) AS i FROM possible)
), matched AS (
  SELECT doc_id, list(DISTINCT label) AS more, max(part) AS part FROM part WHERE part >= {license.THRESHOLD} GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  array_to_string(list_sort(coalesce(named, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(named, []), coalesce(more, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0)::DOUBLE END AS score
FROM doc LEFT JOIN base USING (doc_id) LEFT JOIN matched USING (doc_id)
"""


@query("op9_license_windows", LICENSE_WINDOWS_SQL)
def op9_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and licence notices in all documents, notices across line ends and within bounded windows."""
    return license.scan_windows(table(spark, sf_dir, "documents"))


ROLLUP_SQL = """
WITH counted AS (
  SELECT source, lang, n_chars, unnest([
    {'tokenizer': 'space-1', 'tokens': len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))},
    {'tokenizer': 'alnum-1', 'tokens': len(regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))}]) AS c
  FROM documents
)
SELECT source, lang, c.tokenizer AS tokenizer,
  CAST(sum(CASE WHEN n_chars < 200 THEN 0 ELSE 1 END) AS BIGINT) AS docs,
  CAST(sum(CASE WHEN n_chars < 200 THEN 0 WHEN c.tokenizer = 'space-1' THEN c.tokens + 1 ELSE c.tokens END) AS BIGINT) AS tokens,
  CAST(sum(CASE WHEN n_chars < 200 THEN 2 WHEN c.tokenizer = 'space-1' THEN 2 ELSE 1 END) AS BIGINT) AS changes
FROM counted GROUP BY ALL
"""


@query("op8_token_counts", ROLLUP_SQL)
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches over all documents: a load, a deletion, a revision, and the load once more.

    Short documents (under 200 characters) are deleted again; in the revision the first tokenizer counts an end
    token for every document that stayed.
    """
    counts = materialize(rollup.counted(table(spark, sf_dir, "documents")), "counts")
    book = rollup.Rollup(spark, f"{shared_root(spark)}/corpuslens/rollup-{uuid.uuid4().hex}")
    short = F.coalesce(F.col("n_chars") < 200, F.lit(False))
    book.commit("load", rollup.inserts(counts))
    book.commit("short", rollup.deletes(counts.where(short)))
    book.compact()
    revised = counts.where(~short & (F.col("tokenizer") == "space-1")).withColumnsRenamed({"tokens": "was"}).withColumn("tokens", F.col("was") + 1)
    book.commit("end-token", rollup.revisions(revised))
    book.commit("load", rollup.inserts(counts))
    return book.totals()


@query("op8_vocabulary_counts")
def op8_vocabulary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by the ids of a public vocabulary over all documents: a load, the same load again, and the deletion of
    documents whose id is divisible by 50."""
    path = tokenizer_path()
    counts = materialize(rollup.vocabulary_counts(table(spark, sf_dir, "documents"), path, "word_bpe_49k"), "counts")
    book = rollup.Rollup(spark, f"{shared_root(spark)}/corpuslens/rollup-{uuid.uuid4().hex}")
    book.commit("load", rollup.inserts(counts))
    book.compact()
    book.commit("load", rollup.inserts(counts))
    book.commit("deleted", rollup.deletes(counts.where("doc_id % 50 = 0")))
    return book.totals()


@query("op7_neighbours")
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth vector."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op3_lm")
def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interpolated bigram scores of all documents."""
    return lm.score(table(spark, sf_dir, "documents"))


INFILL_SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), unit AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS u, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM doc
), cut AS (
  SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM unit
), part AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM cut
)
SELECT doc_id, CAST(len(u) AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM part
"""


@query("op11_infill", INFILL_SQL)
def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut at lines into prefix, middle and suffix, and put together again."""
    made = infill.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    form, output = F.col("infill.form"), F.col("infill.output")
    return made.select(
        "doc_id", "infill.n", form.alias("form"), "infill.prefix_chars", "infill.middle_chars",
        F.sha2(output, 256).alias("output_sha256"), F.sha2(infill.restore(form, output), 256).alias("restored_sha256"),
    )


@query("op12_language")
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents by models of the training folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs)
    best = F.coalesce("language.best", F.lit(langid.UNDETERMINED))
    return langid.identify(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), best.alias("lang_pred"),
        F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected"),
    )


DIALOGUE_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
), raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), coded AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 20 AS code
  FROM raw, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM coded
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, substr(role, 1, 1) AS ini
  FROM damaged
), flawed AS (
  SELECT *, coalesce(lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini NOT IN ('su', 'ua', 'au'), false) AS illegal,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS flaw
  FROM placed
), counted AS (
  SELECT conv_id, max(i) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (flaw = 'blank') AS blank,
    count(*) FILTER (flaw = 'duplicate') AS duplicate, count(*) FILTER (flaw = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
  FROM flawed GROUP BY conv_id
), ahead(s, s2, c, a, o) AS (
  VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []), (0, 2, 3, 'I', ['user:']), (1, 2, 3, 'I', ['user:']),
    (3, 2, 3, 'I', ['user:']), (2, 3, 3, 'I', ['assistant:']), (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 3, 6, 'II', ['user:', 'assistant:'])
), edit(a, ini, s2, s3, c, new) AS (
  VALUES ('D', NULL, NULL, NULL, 4, NULL), ('K', 's', 0, 1, 0, NULL), ('K', 'u', 0, 2, 0, NULL), ('K', 'u', 1, 2, 0, NULL), ('K', 'u', 3, 2, 0, NULL),
    ('K', 'a', 2, 3, 0, NULL), ('R', NULL, 0, 2, 3, 'user'), ('R', NULL, 1, 2, 3, 'user'), ('R', NULL, 3, 2, 3, 'user'), ('R', NULL, 2, 3, 3, 'assistant')
), walk(conv_id, i, s, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {'cost': 0, 'audit': '', 'kept': CAST([] AS VARCHAR[])} FROM counted
  UNION ALL
  SELECT w.conv_id, f.i, coalesce(e.s3, h.s2), min({
    'cost': w.best.cost + h.c + e.c + CASE WHEN e.a <> 'D' AND f.flaw = 'truncated' THEN 3 ELSE 0 END,
    'audit': w.best.audit || h.a || e.a,
    'kept': list_concat(w.best.kept, h.o, CASE WHEN e.a = 'D' THEN [] ELSE [coalesce(e.new, f.role) || ':' || f.text] END)})
  FROM walk w JOIN flawed f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
  JOIN ahead h ON h.s = w.s JOIN edit e ON (e.s2 IS NULL OR e.s2 = h.s2) AND (e.ini IS NULL OR e.ini = f.ini)
    AND (e.a = 'D' OR f.flaw NOT IN ('blank', 'duplicate'))
  GROUP BY w.conv_id, f.i, coalesce(e.s3, h.s2)
), done AS (
  SELECT w.conv_id, min({'cost': w.best.cost + h.c, 'audit': w.best.audit || h.a, 'kept': list_concat(w.best.kept, h.o)}) AS best
  FROM walk w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.rows = w.i JOIN ahead h ON h.s = w.s
  WHERE h.s2 IN (0, 3) GROUP BY w.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.kept, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query("op13_dialogue", DIALOGUE_SQL)
def op13_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations damaged, judged and repaired."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return dialogue.report(dialogue.damaged(rows), rows)
