"""Independent SQL for the operators that SQL can express, for DuckDB on the parquet tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


def phrases(least: int = 30, top: int = 2000) -> str:
    """Phrases of 2 to 4 words: every n-gram of every piece is a row."""
    grams = "\nUNION ALL\n".join(
        f"""SELECT lang, list_aggregate(list_slice(words, i, i + {k - 1}), 'string_agg', ' ') AS phrase, {k} AS k
            FROM (SELECT lang, words, unnest(range(1, len(words) - {k - 2})) AS i FROM pieces)"""
        for k in range(1, 5)
    )
    cuts = "\nUNION ALL\n".join(
        f"""SELECT lang, phrase, f, {cut} AS cut,
                   list_aggregate(list_slice(string_split(phrase, ' '), 1, {cut}), 'string_agg', ' ') AS head,
                   list_aggregate(list_slice(string_split(phrase, ' '), {cut + 1}, k), 'string_agg', ' ') AS tail
            FROM candidates WHERE k > {cut}"""
        for cut in range(1, 4)
    )
    inner = "\nUNION ALL\n".join(
        f"""SELECT lang, f, list_aggregate(list_slice(string_split(phrase, ' '), {b}, {b + s - 1}), 'string_agg', ' ') AS phrase
            FROM candidates WHERE k = {k}"""
        for k in (3, 4)
        for s in range(2, k)
        for b in range(1, k - s + 2)
    )
    return rf"""
WITH split AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array({lowered('text')}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
pieces AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM split),
sizes AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS ({grams}),
counted AS (SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {least}),
candidates AS (SELECT * FROM counted WHERE k >= 2),
cuts AS ({cuts}),
scored AS (
    SELECT lang, phrase, a, worst.l AS l, worst.r AS r, worst.score AS score
    FROM (SELECT c.lang, c.phrase, c.f AS a,
                 min({{'score': CAST(CAST(2000000 AS HUGEINT) * c.f // (x.f + y.f) AS BIGINT), 'cut': cut, 'l': x.f, 'r': y.f}}) AS worst
          FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.head
          JOIN counted y ON y.lang = c.lang AND y.phrase = c.tail GROUP BY ALL)),
holders AS (SELECT lang, phrase, max(f) AS most FROM ({inner}) GROUP BY ALL)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, encode(s.phrase)) AS rank
      FROM scored s LEFT JOIN holders h ON h.lang = s.lang AND h.phrase = s.phrase
      WHERE h.most IS NULL OR 100 * h.most < 80 * a)
JOIN sizes USING (lang) WHERE rank <= {top}"""


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lexical_search(k: int = 20) -> str:
    """Every document is scored for every item that shares a term with it."""
    return rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({lowered('text')}, '{TERM}') AS terms FROM documents),
totals AS (
    SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS length FROM docs),
asked AS (
    SELECT item_id, term, count(*) AS times
    FROM (SELECT item_id, unnest(regexp_extract_all({lowered('text')}, '{TERM}')) AS term FROM benchmark) GROUP BY ALL),
held AS (
    SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM held GROUP BY term), totals),
sizes AS (
    SELECT row, doc_id, CAST(100 - 25 + (25 * len(terms) * n_docs) // length AS BIGINT) AS m FROM docs, totals),
scored AS (
    SELECT item_id, doc_id,
           CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (row) GROUP BY item_id, row, doc_id)
SELECT item_id, rank, doc_id, score
FROM (SELECT item_id, doc_id, score,
             CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
      FROM scored WHERE score > 0)
WHERE rank <= {k}"""


def top_k(k: int = 5, every: int = 50) -> str:
    """Every query against every row, component by component."""
    return f"""
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS d FROM whole),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM parts q JOIN parts c ON q.d = c.d AND q.vec_id <> c.vec_id
    WHERE q.vec_id % {every} = 0 GROUP BY ALL)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
WHERE rank <= {k}"""


ORACLE_SQL = {
    "op11_phrases": phrases(),
    "op12_lexical_search": lexical_search(),
    "op13_topk_nra": top_k(),
}
