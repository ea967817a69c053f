"""SQL that a query of this package must agree with, where SQL can express it."""

from riskloom.llm.licenses import HIDES, RULES, SENTENCES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+')"


CONTAMINATED = f"""
WITH items AS (
  SELECT item_id, words, least(5, len(words)) AS width
  FROM (SELECT item_id, {_words('text')} AS words FROM benchmark) WHERE len(words) > 0),
item_shingles AS (
  SELECT DISTINCT item_id, width, array_to_string(words[pos:pos + width - 1], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, len(words) - width + 2)) AS pos FROM items)),
sizes AS (SELECT item_id, width, count(*) AS n FROM item_shingles GROUP BY ALL),
texts AS (SELECT doc_id, {_words('text')} AS words FROM documents),
doc_shingles AS (
  SELECT DISTINCT doc_id, width, array_to_string(words[pos:pos + width - 1], ' ') AS shingle
  FROM (SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS pos
        FROM texts, (SELECT DISTINCT width FROM items)))
SELECT doc_id, item_id, CAST(count(*) AS INT) AS shared, CAST(any_value(n) AS INT) AS item_shingles
FROM doc_shingles JOIN item_shingles USING (width, shingle) JOIN sizes USING (item_id, width)
GROUP BY doc_id, item_id HAVING count(*) >= 0.75 * any_value(n)
"""

VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM usable a JOIN usable b
  ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT reach.vec_id, links.w FROM reach JOIN links ON reach.other = links.u),
parts AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM parts LEFT JOIN counts USING (vec_id)
"""

GROUPS = f"""
WITH RECURSIVE texts AS (SELECT doc_id, {_words('text')} AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[pos:pos + width - 1], ' ') AS shingle
  FROM (SELECT doc_id, words, least(5, len(words)) AS width, unnest(range(1, len(words) - least(5, len(words)) + 2)) AS pos
        FROM texts WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS w
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, links.w FROM reach JOIN links ON reach.other = links.u),
parts AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM parts LEFT JOIN sizes USING (doc_id)
"""

BOILERPLATE = r"""
WITH bare AS (
  SELECT page_id, url, regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g'), '(?:<[^>]*>)+', chr(10), 'g') AS text
  FROM pages),
own AS (
  SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
    list_transform(string_split(text, chr(10)), lambda x: {x: x, line: trim(x)}) AS parts
  FROM bare),
totals AS (SELECT host, count(*) AS pages FROM own GROUP BY host),
holding AS (
  SELECT host, line, count(*) AS n FROM (
    SELECT host, unnest(list_distinct(list_transform(parts, lambda p: p.line))) AS line FROM own) WHERE line <> '' GROUP BY host, line),
gone AS (
  SELECT host, list(line) AS lines FROM holding JOIN totals USING (host)
  WHERE pages >= 20 AND n > 0.1 * pages GROUP BY host),
cut AS (
  SELECT page_id, host, parts, list_filter(parts, lambda p: NOT list_contains(coalesce(lines, []), p.line)) AS kept
  FROM own LEFT JOIN gone USING (host))
SELECT page_id, host, array_to_string(list_transform(kept, lambda p: p.x), chr(10)) AS text,
  CAST(len(parts) AS INT) AS lines, CAST(len(parts) - len(kept) AS INT) AS dropped_lines
FROM cut
"""


def _licenses() -> str:
    cases = " ".join(f"WHEN '{sentence}' THEN '{name}'" for sentence, name in SENTENCES.items())
    hits: dict[str, list[str]] = {}
    for name, identifiers in RULES:
        pattern = "," + "([^,]*,)*?".join(f"{i.replace('.', '[.]')}," for i in identifiers)
        hits.setdefault(name, []).append(f"regexp_matches(found, '{pattern}')")
    tests = {name: "(" + " OR ".join(parts) + ")" for name, parts in hits.items()}
    for name, hidden in HIDES.items():
        tests[hidden] = f"({tests[hidden]} AND NOT {tests[name]})"
    listed = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in sorted(tests.items()))
    return rf"""
WITH split AS (
  SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '[.;:!?][ \t\r]+|[.;:!?]?\n|[.;:!?]$') AS sentences FROM documents),
normal AS (
  SELECT doc_id, list_transform(sentences, lambda s: trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))) AS sentences FROM split),
ids AS (
  SELECT doc_id, list_filter(list_transform(sentences, lambda s: CASE s {cases} END), lambda i: i IS NOT NULL) AS sentence_ids FROM normal),
ordered AS (SELECT *, ',' || array_to_string(sentence_ids, ',') || ',' AS found FROM ids)
SELECT doc_id, array_to_string(sentence_ids, ',') AS sentence_ids,
  array_to_string(list_filter([{listed}], lambda x: x IS NOT NULL), ',') AS licenses FROM ordered
"""


_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED = rf"""
WITH texts AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
sized AS (SELECT doc_id, terms, len(terms) AS n FROM texts WHERE len(terms) > 0),
totals AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sized),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
postings AS (
  SELECT doc_id, any_value(n) AS n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM sized)
  WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w, docs, length
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length)))) AS BIGINT) AS score
  FROM postings JOIN weights USING (term) JOIN asked USING (term) GROUP BY item_id, doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

ARCHIVED = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
led AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS leader FROM payloads)
SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND leader <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND leader <> page_id THEN leader END AS refers_to
FROM led
"""

INFILLED = """
WITH digests AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
draws AS (
  SELECT *, CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2,
    CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4 FROM digests),
cuts AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM draws),
formed AS (
  SELECT *, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cuts),
parts AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""


ORACLES = {
    "op1_benchmark_decontamination": CONTAMINATED,
    "op2_embedding_near_dedup": VECTORS,
    "op5_license_scan": _licenses(),
    "op6_ngram_jaccard_join": GROUPS,
    "op8_line_dedup": BOILERPLATE,
    "op11_ranked_search": RANKED,
    "op12_warc_archive": ARCHIVED,
    "op13_fill_in_middle": INFILLED,
}
