"""Registered queries of the operators, with DuckDB statements where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm import (
    align, decontam, html_extract, infill, jaccard, langid, linededup, minhash, packing, suffixdedup, topk, urlfilter, wordpiece,
)
from dimweave.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_near_duplicates", """
WITH RECURSIVE words AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[ \\x09-\\x0D]+') IF w <> ''] AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM words
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS n, b.n AS m, count(*) AS c
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (SELECT x, y FROM pairs WHERE 100 * c >= 85 * (n + m - c)
), reach(doc_id, node) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.node = l.x
), comp AS (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sets s LEFT JOIN comp ON s.doc_id = comp.doc_id
""")
def op1_near_duplicates(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_language_id")
def op2_language_id(spark, sf_dir):
    """Learns from two thirds of the documents, predicts all of them."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.predict(docs, model, ["doc_id", "text"]).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op3_main_text")
def op3_main_text(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


def _sql_words(text: str) -> str:
    for pattern, replacement in decontam._CHAIN:
        replacement = replacement.replace("$", "\\")
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return f"string_split(lower(replace(trim({text}), chr(1), '')), ' ')"


_SQL_SLOT = "regexp_matches({0}, '^[@%0-9]')"


@query("op4_decontaminate", f"""
WITH items AS (
  SELECT *, least(len(w), 8) AS width,
         [CASE WHEN x[1] IN ('@', '%') THEN x[1] WHEN {_SQL_SLOT.format('x')} THEN '#' ELSE x END FOR x IN w] AS t
  FROM (SELECT DISTINCT item_id, {_sql_words('text')} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL)
  WHERE len(w) >= 5
), usable AS (
  SELECT item_id, w, width, pos, array_to_string(t[pos + 1 : pos + width], ' ') AS key
  FROM (SELECT *, unnest(range(len(w) - width + 1)) AS pos FROM items)
  WHERE len([x FOR x IN w[pos + 1 : pos + width] IF NOT {_SQL_SLOT.format('x')}]) * 2 >= width
), need AS (SELECT item_id, w, least(count(*), 6) AS need FROM usable GROUP BY ALL
), texts AS (
  SELECT *, [CASE WHEN x[1] IN ('@', '%') THEN x[1] WHEN {_SQL_SLOT.format('x')} THEN '#' ELSE x END FOR x IN dw] AS t
  FROM (SELECT DISTINCT doc_id, text, {_sql_words('text')} AS dw FROM documents WHERE text IS NOT NULL)
), spans AS (
  SELECT doc_id, text, dw, pos, width, array_to_string(t[pos + 1 : pos + width], ' ') AS key
  FROM (SELECT *, unnest(range(len(dw) - width + 1)) AS pos
        FROM texts, (SELECT DISTINCT width FROM usable) WHERE len(dw) >= width)
), matched AS (
  SELECT DISTINCT doc_id, text, dw, item_id, w, s.pos - u.pos AS first, u.pos, u.width
  FROM spans s JOIN usable u ON s.key = u.key AND s.width = u.width
), hits AS (
  SELECT doc_id, text, dw, item_id, w, first
  FROM matched JOIN need USING (item_id, w) GROUP BY ALL HAVING count(*) >= any_value(need)
), slots AS (
  SELECT DISTINCT doc_id, text, item_id, w, first, w[p + 1] AS asked, dw[p + first + 1] AS stands
  FROM (SELECT m.*, unnest(range(m.pos, m.pos + m.width)) AS p FROM matched m
        SEMI JOIN hits USING (doc_id, text, item_id, w, first))
  WHERE {_SQL_SLOT.format('w[p + 1]')}
), wrong AS (
  SELECT doc_id, text, item_id, w, first,
         count(*) <> count(DISTINCT asked) OR count(*) <> count(DISTINCT stands) AS bad, bool_and(asked = stands) AS same
  FROM slots GROUP BY ALL
), found AS (
  SELECT doc_id, text, item_id, bool_or(coalesce(same, true)) AS same
  FROM hits LEFT JOIN wrong USING (doc_id, text, item_id, w, first)
  WHERE NOT coalesce(bad, false) GROUP BY ALL
), per AS (
  SELECT doc_id, text, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items,
         CAST(sum(CASE WHEN same THEN 0 ELSE 1 END) AS BIGINT) AS reworded
  FROM found GROUP BY ALL
)
SELECT d.doc_id, per.n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items,
       coalesce(items, '') AS items, coalesce(reworded, 0) AS reworded
FROM documents d LEFT JOIN per ON d.doc_id = per.doc_id AND d.text = per.text
""")
def op4_decontaminate(spark, sf_dir):
    """As the statement says: its template reading alone."""
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), decontam.alignments)


@query("op5_token_counts")
def op5_token_counts(spark, sf_dir):
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op6_packing")
def op6_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query("op7_line_dedup", """
WITH lines AS (
  SELECT doc_id, text, CAST(no AS INTEGER) - 1 AS no, raw,
         [x FOR x IN regexp_split_to_array(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[ \\x09-\\x0D]+') IF x <> ''] AS w
  FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS no
        FROM documents WHERE text IS NOT NULL)
), first AS (
  SELECT w, min((doc_id, no)) AS place FROM lines WHERE len(w) > 0 GROUP BY w
), cut AS (
  SELECT w, place, i, list_concat(w[1 : i - 1], w[i + 1 : ]) AS rest
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM first WHERE len(w) >= 8)
), near AS (
  SELECT a.w FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND b.place < a.place
  UNION SELECT a.w FROM cut a JOIN first b ON a.rest = b.w AND len(b.w) >= 8 AND b.place < a.place
  UNION SELECT b.w FROM cut a JOIN first b ON a.rest = b.w AND len(b.w) >= 8 AND a.place < b.place
), judged AS (
  SELECT l.doc_id, l.no, l.raw,
         len(l.w) > 0 AND (near.w IS NOT NULL OR (l.doc_id, l.no) > first.place) AS gone
  FROM lines l LEFT JOIN first ON l.w = first.w LEFT JOIN near ON l.w = near.w
)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(*) FILTER (gone) AS INTEGER) AS n_removed,
       coalesce(string_agg(raw, chr(10) ORDER BY no) FILTER (NOT gone), '') AS text
FROM judged GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
""")
def op7_line_dedup(spark, sf_dir):
    return linededup.dedup_lines(table(spark, sf_dir, "documents"))


@query("op8_topk", """
WITH vectors AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS cells
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.cells, c.cells)]) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id AND len(c.cells) = len(q.cells)
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
""")
def op8_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


#: The rules (verdict, host, path).
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@query("op9_url_filter", """
WITH cut AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(verdict, h, p) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), hit AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM cut) c
  JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY ALL
)
SELECT page_id, cut.host, cut.path, rule, coalesce(verdict, 'allow') AS verdict
FROM cut LEFT JOIN hit ON cut.host = hit.host AND cut.path = hit.path
""")
def op9_url_filter(spark, sf_dir):
    return urlfilter.filter_urls(table(spark, sf_dir, "pages"), urlfilter.rule_table(spark, URL_RULES))


@query("op10_suffix_dedup")
def op10_suffix_dedup(spark, sf_dir):
    found = suffixdedup.dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"), (F.size("removed") > 0).alias("holds_repeats"))


@query("op11_jaccard_join", """
WITH RECURSIVE words AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[ \\x09-\\x0D]+') IF w <> ''] AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct([array_to_string(w[i : i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s
  FROM words
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(doc_id, node) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.node = l.x
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, comp.component_id
FROM sets s JOIN (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY doc_id) comp ON s.doc_id = comp.doc_id
""")
def op11_jaccard_join(spark, sf_dir):
    return jaccard.linked_classes(table(spark, sf_dir, "documents"))


@query("op12_infill", r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), drawn AS (
  SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS c2,
         text = '' OR regexp_matches(text, '<[PSM]>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 AS plain,
         CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 AS spm
  FROM units
), cut AS (
  SELECT doc_id, text, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(u[1 : least(c1, c2)], '') AS p,
         array_to_string(u[least(c1, c2) + 1 : greatest(c1, c2)], '') AS m,
         array_to_string(u[greatest(c1, c2) + 1 :], '') AS s
  FROM drawn
), made AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                      ELSE '<P>' || p || '<S>' || s || '<M>' || m END AS output
  FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output
              WHEN 'spm' THEN regexp_replace(output, '^<S>(.*)<P>(.*)<M>(.*)$', '\2\3\1', 's')
              ELSE regexp_replace(output, '^<P>(.*)<S>(.*)<M>(.*)$', '\1\3\2', 's') END) AS restored_sha256
FROM made
""")
def op12_infill(spark, sf_dir):
    return infill.digests(infill.transform(infill.store(table(spark, sf_dir, "documents"))))


@query("op13_token_alignment")
def op13_token_alignment(spark, sf_dir):
    return align.profiles(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
