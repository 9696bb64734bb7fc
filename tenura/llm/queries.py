"""The registered query of each operator, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenura.llm import (
    decontaminate, divergence, exact_dedup, extract, line_dedup, packing, simhash, substring_dedup, token_grammar, toxicity,
    url_filter, warc, whitening,
)
from tenura.llm.tables import table


def op1_extract(spark, sf):
    return extract.extract(table(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")


def op2_exact_dedup(spark, sf):
    return exact_dedup.exact_groups(table(spark, sf, "documents")).drop("n_same")


OP2 = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents),
     g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS n FROM d GROUP BY h)
SELECT doc_id, keep_id, n AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, h AS text_sha256 FROM d JOIN g USING (h)"""


def op3_url_filter(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def _hit(term: str) -> str:
    return rf"regexp_matches(u, '(^|[^\p{{L}}]){term}([^\p{{L}}]|$)')"


_STRICT = " OR ".join(map(_hit, url_filter.STRICT))
_SOFT = " + ".join(f"CASE WHEN {_hit(t)} THEN {w} ELSE 0 END" for t, w in url_filter.SOFT.items())
_RULES = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.text}'"
    for r in sorted(url_filter.RULES, key=lambda r: -len(r.text))
)
_VERDICTS = " ".join(f"WHEN '{r.text}' THEN '{r.verdict}'" for r in url_filter.RULES)
OP3 = rf"""
WITH a AS (
  SELECT page_id, lower(coalesce(url, '')) AS u, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
r AS (SELECT *, CASE {_RULES} END AS rule FROM a)
SELECT page_id, host, path, rule, CASE rule {_VERDICTS} ELSE CASE WHEN {_STRICT} OR {_SOFT} >= {url_filter.SOFT_LIMIT} THEN 'block' ELSE 'allow' END END AS verdict FROM r"""


def vocabulary() -> str:
    """The public vocabulary file that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_warc(spark, sf):
    found = warc.archive_and_read(table(spark, sf, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4 = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
     g AS (SELECT h, max(page_id) AS first FROM p WHERE n >= {warc.LEAST_REVISIT} GROUP BY h)
SELECT page_id, n AS payload_bytes, p.h AS payload_digest, CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < first THEN first END AS refers_to FROM p LEFT JOIN g ON p.h = g.h AND n >= {warc.LEAST_REVISIT}"""


def op5_token_grammar(spark, sf):
    return token_grammar.token_table(table(spark, sf, "documents"), vocabulary(), end_id=1)


def op6_decontaminate(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items_sha256", "contaminated")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_RUNS = " UNION ALL ".join(
    f"SELECT * FROM (SELECT doc_id, i, {k} AS k, string_agg(word, ' ' ORDER BY i) OVER w AS s, count(*) OVER w AS n FROM dw WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {k - 1} FOLLOWING)) WHERE n = {k}"
    for k in range(1, decontaminate.WINDOW + 1)
)
OP6 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT item_id, w, least({decontaminate.WINDOW}, len(w)) AS k, unnest(range(1, len(w) - least({decontaminate.WINDOW}, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
m AS (SELECT doc_id, i, r.k, item_id FROM ({_RUNS}) r JOIN bw ON bw.k = r.k AND bw.s = r.s),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS x FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items, sha256(coalesce(x, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND {decontaminate.ONE_WORD_IN} * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN found ON found.doc_id = d.doc_id"""


def op7_simhash(spark, sf):
    groups = simhash.near_groups(table(spark, sf, "documents"))
    return groups.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op8_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), vocabulary(), end_id=0)


def op9_line_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs).select("doc_id", "text", "n_lines", "n_dropped")


OP9 = f"""
WITH l AS (SELECT doc_id, source, i, string_split(text, chr(10))[i] AS line
           FROM (SELECT *, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)),
     p AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
     c AS (SELECT source, trim(line, ' ') AS line, count(DISTINCT doc_id) AS n FROM l WHERE trim(line, ' ') <> '' GROUP BY ALL),
     b AS (SELECT c.source, line FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source WHERE n >= {line_dedup.LEAST_PAGES} AND n > {line_dedup.RATIO} * pages),
     k AS (SELECT l.*, b.line IS NOT NULL AS dropped FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source AND trim(l.line, ' ') = b.line)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(string_agg(k.line, chr(10) ORDER BY k.i) FILTER (NOT dropped), '') END AS text,
       count(k.i) AS n_lines, count(k.i) FILTER (dropped) AS n_dropped
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id GROUP BY d.doc_id, d.text"""


def op10_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    net = toxicity.fit(docs, table(spark, sf, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, net).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_whitening(spark, sf):
    return whitening.by_component(whitening.whiten(table(spark, sf, "embeddings")))


def op12_divergence(spark, sf):
    return divergence.audit(table(spark, sf, "documents").select("text", "lang", "source"))


OP12 = rf"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {divergence.LEAST_DOCS}),
v AS (SELECT l.lang, count(term) AS v FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN k USING (lang) GROUP BY l.lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT s.lang, s.source, coalesce(sum(n), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN c USING (lang, source) GROUP BY ALL),
l AS (SELECT lang, sum(n)::HUGEINT AS n FROM g GROUP BY lang),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * v) AS p
      FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT p.lang, term, 1 + (1000000000::HUGEINT * (sum(p.n)::HUGEINT + 2)) // (any_value(l.n) + 2 * any_value(v)) AS q FROM p JOIN l USING (lang) JOIN v USING (lang) GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) FROM p x JOIN p y USING (lang, term) WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM (FROM pair UNION ALL FROM term))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}"""


def op13_substring_dedup(spark, sf):
    cut = substring_dedup.remove_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


_SIZE = substring_dedup.WINDOW
OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT r, doc_id, i, array_to_string(w[i:i + {_SIZE - 1}], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - {_SIZE - 2})) AS i FROM d WHERE len(w) >= {_SIZE})),
f AS (SELECT s, min(coalesce(doc_id, -9223372036854775808)) AS low FROM x GROUP BY s),
h AS (SELECT DISTINCT r, unnest(range(i, i + {_SIZE})) AS p FROM x JOIN f USING (s) WHERE doc_id > low),
k AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS kept FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN h USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT r, count(*) AS n FROM h GROUP BY r) USING (r) LEFT JOIN k USING (r)"""


QUERIES = {
    f.__name__: f
    for f in [
        op1_extract, op2_exact_dedup, op3_url_filter, op4_warc, op5_token_grammar, op6_decontaminate, op7_simhash, op8_packing, op9_line_dedup,
        op10_toxicity, op11_whitening, op12_divergence, op13_substring_dedup,
    ]
}
SQL = {"op2_exact_dedup": OP2, "op3_url_filter": OP3, "op4_warc": OP4, "op6_decontaminate": OP6, "op9_line_dedup": OP9, "op12_divergence": OP12, "op13_substring_dedup": OP13}
