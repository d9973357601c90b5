"""DuckDB SQL that computes the same tables as the registered queries.

The SQL is an independent statement of each operator's semantics, written against the
same parquet tables (pre-registered views).  Dialect notes: DuckDB's RE2 has no
back-references, so "a letter three times" is spelled as an alternation of ``a{3,}`` ...;
``\\x{..}`` escapes are read the same way by Java and RE2; doubles are rounded as in the
Spark queries; decimal literals are cast to DOUBLE.
"""

from __future__ import annotations

import string

from ..functions import text as TX
from ..sources.standins import NETWORK_CHANNEL_MEANS

SEED = 16
N_DOCS = "(SELECT count(*) FROM documents)"
LI_ORDER = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
            "l_tax, l_returnflag, l_linestatus, l_shipdate")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ws_class() -> str:
    return "".join("\\x{%x}" % ord(c) for c in TX.PY_WHITESPACE)


WS = _ws_class()


def lower_strip(x: str) -> str:
    return f"regexp_replace(lower({x}), '^[{WS}]+|[{WS}]+$', '', 'g')"


def remove_url(x: str) -> str:
    return f"regexp_replace({x}, 'https?:[^{WS}]+', ' ', 'g')"


def remove_escapes(x: str) -> str:
    return f"regexp_replace({x}, {_q(TX.ESCAPE_PATTERN)}, ' ', 'g')"


def clean_text(x: str) -> str:
    return remove_escapes(remove_url(lower_strip(x)))


def tokens(x: str) -> str:
    return f"regexp_extract_all({lower_strip(x)}, '[a-z]{{2,}}')"


W = "[\\p{L}\\p{N}_]"
FIND3 = W + "*(?:" + "|".join(c + "{3,}" for c in string.ascii_letters) + ")" + W + "*"
PIECES = W + "+|[^\\p{L}\\p{N}_]+"


def drop_repeated(x: str, n: int, keep_double: bool = False) -> str:
    out = x
    for c in string.ascii_lowercase + string.digits:
        out = f"regexp_replace({out}, '{c}{{{n},}}', '{c * (2 if keep_double else 1)}', 'g')"
    return out


def _stop_values() -> str:
    return ", ".join(f"({_q(w)})" for w in TX.ENGLISH_STOP_WORDS)


def _number_values() -> str:
    return ", ".join(f"({_q(w)})" for w in TX.NUMBER_WORDS)


# ---------------------------------------------------------------------------
# Sources, filters, joins, sampling
# ---------------------------------------------------------------------------

RING = "part_ids AS (SELECT p_partkey AS business_id FROM part WHERE coalesce(contains(lower(p_name), 'ring'), false))"


def _chunked(match: str, size: int = 1000) -> str:
    per = int(size / 20)
    key = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
    return f"""
WITH {RING},
numbered AS (SELECT *, row_number() OVER (ORDER BY {LI_ORDER}) - 1 AS rix FROM lineitem),
chunked AS (SELECT *, (rix // {size})::BIGINT AS chunk FROM numbered WHERE {match}),
picked AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY md5({key} || ':{SEED}'), {LI_ORDER}) AS rn
           FROM chunked),
kept AS (SELECT * FROM picked WHERE rn <= {per}),
per_chunk AS (SELECT chunk, sum(count(*)) OVER (ORDER BY chunk) - count(*) AS before FROM kept GROUP BY chunk)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, chunk
FROM kept WHERE chunk IN (SELECT chunk FROM per_chunk WHERE before < {size})"""


PHOTOS = "photos AS (SELECT CAST(vec_id AS VARCHAR) AS photo_id, label FROM embeddings)"
FILES = ("files AS (SELECT file_name, split_part(file_name, '.jpg', 1) AS photo_id FROM "
         "(SELECT CAST(vec_id AS VARCHAR) || '.jpg' AS file_name FROM embeddings WHERE vec_id % 3 <> 0))")
SAMPLED = f"""sampled AS (SELECT photo_id, label FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(photo_id || ':{SEED}'), photo_id) AS rn
    FROM photos WHERE photo_id IN (SELECT photo_id FROM files)) WHERE rn <= 5)"""


def _sources() -> dict[str, str]:
    return {
        "json_roundtrip": "SELECT doc_id, text, lang FROM documents",
        "contains_ci_filter": "SELECT p_partkey AS business_id, p_name AS categories FROM part "
                              "WHERE coalesce(contains(lower(p_name), 'ring'), false)",
        "inlist_filter": "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem WHERE l_linenumber IN (1, 2)",
        "semi_join_reviews": f"WITH {RING} SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem "
                             "WHERE l_linenumber IN (1, 2) AND l_partkey IN (SELECT business_id FROM part_ids)",
        "load_reviews_lineitem": _chunked("l_linenumber IN (1, 2, 3, 4) AND l_partkey IN (SELECT business_id FROM part_ids)"),
        "chunk_sample": _chunked("l_linenumber IN (1, 2)"),
        "load_reviews_text": f"SELECT doc_id, {clean_text('text')} AS text FROM documents "
                             "WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)",
        "sample_n": f"SELECT doc_id, lang FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || ':{SEED}'), doc_id LIMIT 100",
        "photo_meta": "SELECT CAST(vec_id AS VARCHAR) AS photo_id, label, "
                      "'/data/photos/' || CAST(vec_id AS VARCHAR) || '.jpg' AS photo_path FROM embeddings",
        "photos_available": f"WITH {PHOTOS}, {FILES} SELECT photo_id, label FROM photos "
                            "WHERE photo_id IN (SELECT photo_id FROM files)",
        "stratified_sample": f"WITH {PHOTOS}, {FILES}, {SAMPLED} SELECT photo_id, label FROM sampled",
        "stratified_sample_large": f"""SELECT stars, review_key FROM (
    SELECT *, row_number() OVER (PARTITION BY stars ORDER BY md5(review_key || ':{SEED}'), review_key) AS rn FROM (
      SELECT l_linenumber AS stars, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS review_key
      FROM lineitem)) WHERE rn <= 1500""",
        "retention_manifest": f"WITH {PHOTOS}, {FILES}, {SAMPLED} SELECT photo_id, file_name FROM files "
                              "WHERE photo_id NOT IN (SELECT photo_id FROM sampled)",
    }


# ---------------------------------------------------------------------------
# Text
# ---------------------------------------------------------------------------

KNOWN = f"""known AS (SELECT term FROM (SELECT DISTINCT doc_id, unnest({tokens('text')}) AS term FROM documents)
         GROUP BY term HAVING count(*) >= 5)"""


def _correct_repeated(lemma: bool = False) -> str:
    cands = [("0", "word"), ("1", drop_repeated("word", 2)), ("2", drop_repeated("word", 3)),
             ("3", drop_repeated("word", 3, True))]
    cand_sql = " UNION ALL ".join(f"SELECT word, {k} AS k, {e} AS form FROM weird" for k, e in cands)
    known = KNOWN
    if lemma:  # the vocabulary holds lemmas only; a form's lemma is tried right after the form
        lexicon = LEXICON.format(tokens=tokens("text"))
        known = f"""lex AS ({lexicon}),
{KNOWN.replace("known AS", "frequent AS")},
known AS (SELECT term FROM frequent WHERE term NOT IN (SELECT token FROM lex WHERE token <> lemma))"""
        forms = " UNION ALL ".join(f"SELECT word, 2 * {k} AS k, {e} AS form FROM weird" for k, e in cands)
        cand_sql = (f"SELECT * FROM ({forms}) UNION ALL SELECT word, k + 1, coalesce(lex.lemma, form) FROM ({forms}) f "
                    "LEFT JOIN lex ON lex.token = f.form")
    return f"""
WITH {known},
docs AS (SELECT doc_id, {clean_text('text')} AS text FROM documents),
found AS (SELECT doc_id, unnest(regexp_extract_all(text, {_q(FIND3)})) AS word FROM docs),
weird AS (SELECT DISTINCT word FROM found),
cand AS ({cand_sql}),
fixes AS (SELECT word, arg_min(form, k) AS correction FROM cand WHERE form IN (SELECT term FROM known)
          GROUP BY word HAVING arg_min(form, k) <> word),
fixed_docs AS (SELECT DISTINCT doc_id FROM found WHERE word IN (SELECT word FROM fixes)),
pieces AS (SELECT d.doc_id, unnest(regexp_extract_all(d.text, {_q(PIECES)})) AS piece,
                  unnest(range(1, len(regexp_extract_all(d.text, {_q(PIECES)})) + 1)) AS ord
           FROM docs d WHERE d.doc_id IN (SELECT doc_id FROM fixed_docs)),
rebuilt AS (SELECT p.doc_id, string_agg(coalesce(f.correction, p.piece), '' ORDER BY p.ord) AS text
            FROM pieces p LEFT JOIN fixes f ON f.word = p.piece GROUP BY p.doc_id)
SELECT d.doc_id, coalesce(r.text, d.text) AS text FROM docs d LEFT JOIN rebuilt r USING (doc_id)"""


NUMBER = r"^[+\-±~]?\p{Sc}?\p{Nd}+([.,/]\p{Nd}+)*[.,]?$"
ORDINAL = r"^\p{Nd}+([sS][tT]|[nN][dD]|[rR][dD]|[tT][hH])$"
RAW_TOKENS = r"regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+')"
LEXICON = """(SELECT token, lemma, CASE WHEN lemma <> token THEN 'VERB' WHEN length(token) % 2 = 0 THEN 'ADJ' ELSE 'NOUN' END AS tag
    FROM (SELECT token, CASE WHEN length(regexp_replace(token, '(ing|ed|s)$', '')) >= 3
                             THEN regexp_replace(token, '(ing|ed|s)$', '') ELSE token END AS lemma
          FROM (SELECT DISTINCT unnest({tokens}) AS token FROM documents) WHERE regexp_full_match(token, '[a-z]+')))"""
CUSTOM = "('the', 'tion', 'that', 'erst', 'onth')"


def _kept(tok_sql: str, extra_join: str = "", extra_where: str = "", term: str = "toks.term", more: str = "") -> str:
    return f"""
WITH stop(term) AS (VALUES {_stop_values()}),
numwords(term) AS (VALUES {_number_values()}),
toks AS (SELECT id AS doc_id, unnest(t) AS term, unnest(range(len(t))) AS pos FROM ({tok_sql})),
kept AS (SELECT toks.doc_id, toks.pos, {term} AS term FROM toks {extra_join}
         WHERE toks.term NOT IN (SELECT term FROM stop) AND lower(toks.term) NOT IN (SELECT term FROM numwords)
           AND NOT regexp_matches(toks.term, '^\\p{{P}}+$') AND NOT regexp_matches(toks.term, '^[{WS}]+$')
           AND NOT regexp_matches(toks.term, '^\\p{{Nd}}+$')
           AND NOT regexp_matches(toks.term, '{NUMBER}') AND NOT regexp_matches(toks.term, '{ORDINAL}') {extra_where}),
agg AS (SELECT doc_id, string_agg(term, ' ' ORDER BY pos) AS text, count(*)::INTEGER AS n FROM kept GROUP BY doc_id)
SELECT i.id AS doc_id, {more}coalesce(agg.text, '') AS text FROM ({tok_sql}) i LEFT JOIN agg ON agg.doc_id = i.id"""


def _text() -> dict[str, str]:
    part_tok = f"SELECT p_partkey AS id, {tokens('p_name')} AS t FROM part"
    lex = ("JOIN (SELECT DISTINCT token, pos AS tag FROM (SELECT string_split(p_name, ' ')[1] AS token, 'ADJ' AS pos "
           "FROM part UNION ALL SELECT string_split(p_name, ' ')[2], 'NOUN' FROM part)) lex ON lex.token = toks.term")
    return {
        "lower_strip": f"SELECT doc_id, {lower_strip('text')} AS text FROM documents",
        "remove_url": f"SELECT page_id, {remove_url(chr(39) + 'see ' + chr(39) + ' || url || ' + chr(39) + ' now' + chr(39))} "
                      "AS text FROM pages",
        "remove_escapes": f"SELECT doc_id, {remove_escapes('text')} AS text FROM documents",
        "find_repeated": f"SELECT doc_id, CAST(len(m) AS INTEGER) AS n_words, array_to_string(m, '|') AS words "
                         f"FROM (SELECT doc_id, regexp_extract_all(text, {_q(FIND3)}) AS m FROM documents)",
        "drop_repeated": f"SELECT doc_id, {drop_repeated('text', 3)} AS text FROM documents",
        "drop_repeated_double": f"SELECT doc_id, {drop_repeated('text', 3, True)} AS text FROM documents",
        "tokenize": f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS text "
                    f"FROM (SELECT doc_id, {tokens('text')} AS t FROM documents)",
        "correct_repeated": _correct_repeated(),
        "clean_tokens": _kept(f"SELECT doc_id AS id, {tokens('text')} AS t FROM documents"),
        "pos_filter": _kept(part_tok, lex, "AND lex.tag = 'NOUN'"),
        "clean_raw_tokens": _kept(f"SELECT doc_id AS id, {RAW_TOKENS} AS t FROM documents",
                                  f"JOIN {LEXICON.format(tokens=RAW_TOKENS)} lex ON lex.token = toks.term",
                                  f"AND lex.tag IN ('NOUN', 'ADJ') AND lex.lemma NOT IN {CUSTOM}", "lex.lemma"),
        "clean_marked_tokens": _kept(f"SELECT doc_id AS id, {RAW_TOKENS} AS t FROM documents", "",
                                     f"AND toks.term NOT IN {CUSTOM}", more="coalesce(agg.n, 0)::INTEGER AS n_tokens, "),
        "number_tokens": rf"""WITH numwords(term) AS (VALUES {_number_values()}),
t AS (SELECT unnest(regexp_extract_all(html, '[^\x20\x09-\x0D<>]+')) AS token FROM pages)
SELECT token, count(*) AS n, regexp_matches(token, '^\p{{P}}+$') AS punct, regexp_matches(token, '^\p{{Nd}}+$') AS digit,
       regexp_matches(token, '{NUMBER}') OR regexp_matches(token, '{ORDINAL}') OR lower(token) IN (SELECT term FROM numwords) AS number
FROM t GROUP BY token""",
        "correct_repeated_lemma": _correct_repeated(lemma=True),
        "suggest_types_text": """SELECT * FROM (VALUES ('event_id', 'int64', 'BIGINT'), ('ts', 'datetime64[ns]', 'TIMESTAMP'),
    ('ts_broken', 'datetime64[ns]', 'TIMESTAMP'), ('ts_note', 'category', 'CATEGORY'), ('event_type', 'category', 'CATEGORY')
    ) t(column_name, numpy_type, suggested_type) WHERE column_name <> 'event_id'
UNION ALL SELECT 'event_id', CASE WHEN mx <= 255 THEN 'uint8' WHEN mx <= 65535 THEN 'uint16' WHEN mx <= 4294967295 THEN 'uint32' ELSE 'int64' END,
       CASE WHEN mx <= 127 THEN 'TINYINT' WHEN mx <= 32767 THEN 'SMALLINT' WHEN mx <= 2147483647 THEN 'INT' ELSE 'BIGINT' END
FROM (SELECT max(event_id) AS mx FROM events)""",
        "parse_timestamps": """SELECT event_id, date_trunc('second', ts) AS ts,
       CASE WHEN event_id % 7 <> 0 THEN date_trunc('second', ts) END AS ts_broken, NULL::TIMESTAMP AS ts_note FROM events""",
    }


# ---------------------------------------------------------------------------
# Vocabulary, bag of words, TF-IDF
# ---------------------------------------------------------------------------

COUNTS = f"""doc_tokens AS (SELECT doc_id, lang, {tokens('text')} AS t FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM doc_tokens) GROUP BY doc_id, term),
vocab AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM counts GROUP BY term)"""


def _filtered(keep_n: int) -> str:
    return f"""filtered AS (SELECT term, CAST(row_number() OVER (ORDER BY df DESC, term) - 1 AS INTEGER) AS term_id, df, cf
    FROM vocab WHERE df >= 5 AND df <= floor(0.5 * {N_DOCS}) ORDER BY df DESC, term LIMIT {keep_n})"""


def _tfidf_cte(keep_n: int = 100_000) -> str:
    return f"""{COUNTS}, {_filtered(keep_n)},
bow AS (SELECT c.doc_id, f.term_id, c.tf, f.df FROM counts c JOIN filtered f USING (term)),
raw AS (SELECT doc_id, term_id, tf * log2({N_DOCS} / df) AS w FROM bow),
normed AS (SELECT doc_id, term_id, CASE WHEN sqrt(sum(w * w) OVER (PARTITION BY doc_id)) > 0
           THEN w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) ELSE 0 END AS weight FROM raw),
tfidf AS (SELECT * FROM normed WHERE abs(weight) >= 1e-12)"""


def _vectors() -> dict[str, str]:
    wide_cols = ", ".join(
        f"round(coalesce(max(CASE WHEN t.term_id = {i} THEN t.weight END), 0), 6) AS w{i}" for i in range(20))
    return {
        "vocabulary": f"WITH {COUNTS} SELECT term, df, cf FROM vocab",
        "filter_extremes": f"WITH {COUNTS}, {_filtered(100_000)} SELECT term, term_id, df, cf FROM filtered",
        "bag_of_words": f"WITH {COUNTS}, {_filtered(100_000)} SELECT c.doc_id, f.term_id, c.tf FROM counts c "
                        "JOIN filtered f USING (term)",
        "tfidf": f"WITH {_tfidf_cte()} SELECT doc_id, term_id, round(weight, 6) AS weight FROM tfidf",
        "tfidf_top_terms": f"""WITH {_tfidf_cte()},
per AS (SELECT d.lang, t.term_id, sum(t.weight) AS score FROM tfidf t JOIN doc_tokens d USING (doc_id)
        GROUP BY d.lang, t.term_id),
named AS (SELECT p.lang, f.term, p.score, row_number() OVER (PARTITION BY p.lang ORDER BY round(p.score, 9) DESC, f.term) AS rk
          FROM per p JOIN filtered f USING (term_id))
SELECT lang, CAST(rk AS INTEGER) AS "rank", term, round(score, 6) AS score FROM named WHERE rk <= 10""",
        "vector_lookup": f"WITH {_tfidf_cte()} SELECT doc_id, term_id, round(weight, 6) AS weight FROM tfidf "
                         "WHERE doc_id = (SELECT min(doc_id) FROM documents)",
        "sparse_vectors": f"WITH {_tfidf_cte()} SELECT d.doc_id, CAST(count(t.term_id) AS INTEGER) AS n_terms, "
                          "coalesce(string_agg(CAST(t.term_id AS VARCHAR), ',' ORDER BY t.term_id), '') AS indices, "
                          "round(coalesce(sum(t.weight), 0), 6) AS total_weight FROM documents d "
                          "LEFT JOIN tfidf t ON t.doc_id = d.doc_id GROUP BY d.doc_id",
        "nonzero_counts": f"WITH {_tfidf_cte()} SELECT f.term_id, {N_DOCS} AS n_rows, count(n.weight) FILTER (WHERE n.weight > 0) "
                          "AS n_nonzero FROM filtered f LEFT JOIN normed n USING (term_id) GROUP BY f.term_id",
        "sparse_to_wide": f"WITH {_tfidf_cte()} SELECT d.doc_id, {wide_cols} FROM documents d "
                          "LEFT JOIN tfidf t ON t.doc_id = d.doc_id GROUP BY d.doc_id",
        "wide_rows": f"WITH {_tfidf_cte()} SELECT d.doc_id, (SELECT count(*) FROM filtered)::INTEGER AS width, "
                     "count(t.weight) FILTER (WHERE t.weight <> 0)::INTEGER AS n_nonzero, round(coalesce(sum(t.weight), 0), 5) AS total, "
                     "round(coalesce(sum(t.weight * (t.term_id + 1)), 0), 3) AS by_place FROM documents d "
                     "LEFT JOIN tfidf t ON t.doc_id = d.doc_id GROUP BY d.doc_id",
    }


# ---------------------------------------------------------------------------
# Topic diagnostics (proxy model: topic = language)
# ---------------------------------------------------------------------------

PROXY = f"""{COUNTS},
known AS (SELECT term FROM vocab WHERE df >= 5),
kc AS (SELECT c.doc_id, c.term, c.tf, d.lang AS topic FROM counts c JOIN known USING (term) JOIN doc_tokens d USING (doc_id)),
per AS (SELECT topic, term, sum(tf) AS c FROM kc GROUP BY topic, term),
tt AS (SELECT topic, term, c / sum(c) OVER (PARTITION BY topic) AS p FROM per),
doc_len AS (SELECT doc_id, sum(tf) AS n_tokens FROM kc GROUP BY doc_id),
prev AS (SELECT topic, size, size / sum(size) OVER () AS share FROM (
    SELECT d.lang AS topic, CAST(sum(1.0::DOUBLE * l.n_tokens) AS DOUBLE) AS size
    FROM doc_tokens d JOIN doc_len l USING (doc_id) GROUP BY d.lang)),
tf_all AS (SELECT term, CAST(sum(tf) AS BIGINT) AS freq FROM kc GROUP BY term),
pw AS (SELECT term, freq / (SELECT sum(freq) FROM tf_all) AS pw FROM tf_all),
est AS (SELECT tt.topic, tt.term, tt.p * prev.size AS est_freq FROM tt JOIN prev USING (topic))"""


def _coherence(n: int) -> str:
    """u_mass of the ``n`` top terms of every topic, from a self-join of the documents that hold them."""
    return f"""{PROXY},
top AS (SELECT topic, term, rk FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY p DESC, term) AS rk FROM tt)
        WHERE rk <= {n}),
dt AS (SELECT DISTINCT doc_id, term FROM kc),
hits AS (SELECT top.topic, top.rk, dt.doc_id FROM top JOIN dt USING (term)),
occ AS (SELECT topic, rk, count(*) AS d FROM hits GROUP BY topic, rk),
co AS (SELECT a.topic, a.rk AS ri, b.rk AS rj, count(*) AS d FROM hits a JOIN hits b
       ON a.doc_id = b.doc_id AND a.topic = b.topic AND a.rk > b.rk GROUP BY a.topic, a.rk, b.rk),
pairs AS (SELECT i.topic, i.rk AS ri, j.rk AS rj FROM top i JOIN top j ON i.topic = j.topic AND i.rk > j.rk),
n AS (SELECT count(*)::DOUBLE AS n FROM documents),
coh AS (SELECT p.topic, avg(ln((coalesce(co.d, 0) / n.n + 1e-12) / (occ.d / n.n))) AS coherence
FROM pairs p LEFT JOIN co USING (topic, ri, rj) JOIN occ ON occ.topic = p.topic AND occ.rk = p.rj, n
GROUP BY p.topic)"""


def _fold_in(steps: int) -> str:
    """EM for p(t|d) with p(w|t) fixed, from equal shares."""
    ctes = [PROXY, """words AS MATERIALIZED (SELECT doc_id, term, SUM(tf) AS tf FROM kc GROUP BY doc_id, term),
cell AS MATERIALIZED (SELECT w.doc_id, w.term, w.tf, tt.topic, tt.p FROM words w JOIN tt USING (term)),
len AS (SELECT doc_id, sum(tf) AS n FROM words GROUP BY doc_id),
s0 AS (SELECT doc_id, topic, 1.0::DOUBLE / (SELECT count(DISTINCT topic) FROM tt) AS p FROM len CROSS JOIN (SELECT DISTINCT topic FROM tt))"""]
    for i in range(steps):
        ctes.append(f"""s{i + 1} AS MATERIALIZED (SELECT s.doc_id, s.topic, coalesce(g.m, 0) / len.n AS p FROM s{i} s JOIN len USING (doc_id) LEFT JOIN (
    SELECT doc_id, topic, sum(tf * mix / tot) AS m FROM (
        SELECT c.doc_id, c.topic, c.tf, c.p * s.p AS mix, sum(c.p * s.p) OVER (PARTITION BY c.doc_id, c.term) AS tot
        FROM cell c JOIN s{i} s USING (doc_id, topic)) GROUP BY doc_id, topic) g USING (doc_id, topic))""")
    return f"WITH {', '.join(ctes)} SELECT doc_id, topic, round(p, 6) AS p FROM s{steps}"


def _topics() -> dict[str, str]:
    return {
        "fold_in_topics": _fold_in(4),
        "topic_report_terms": f"""WITH {_coherence(20)},
top40 AS (SELECT topic, term, p, rk FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY p DESC, term) AS rk FROM tt)
          WHERE rk <= 40),
listed AS (SELECT topic, string_agg(term, ' ' ORDER BY rk) AS terms, string_agg(format('{{:.5f}}', p), ' ' ORDER BY rk) AS weights
           FROM top40 GROUP BY topic)
SELECT topic, terms, weights, round(coherence, 2) AS coherence FROM listed JOIN coh USING (topic)""",
        "term_frequency": f"WITH {PROXY} SELECT term, freq FROM tf_all",
        "topic_prevalence": f"WITH {PROXY} SELECT topic, round(size, 6) AS size, round(share, 6) AS share FROM prev",
        "topic_term_estimate": f"WITH {PROXY} SELECT topic, term, round(est_freq, 6) AS est_freq FROM est",
        "term_topic_distribution": f"WITH {PROXY} SELECT term, topic, "
                                   "round(est_freq / sum(est_freq) OVER (PARTITION BY term), 6) AS share FROM est",
        "term_saliency": f"""WITH {PROXY},
j AS (SELECT tt.term, tt.p * prev.share AS joint, prev.share AS pt FROM tt JOIN prev USING (topic)),
ptw AS (SELECT term, pt, joint / sum(joint) OVER (PARTITION BY term) AS ptw FROM j),
dist AS (SELECT term, sum(CASE WHEN ptw > 0 THEN ptw * ln(ptw / pt) ELSE 0 END) AS d FROM ptw GROUP BY term),
sal AS (SELECT dist.term, round(pw.pw * dist.d, 10) AS saliency FROM dist JOIN pw USING (term))
SELECT term, CAST(row_number() OVER (ORDER BY saliency DESC, term) AS INTEGER) AS "rank", round(saliency, 6) AS saliency
FROM sal ORDER BY saliency DESC, term LIMIT 30""",
        "term_relevance": f"""WITH {PROXY},
rel AS (SELECT tt.topic, tt.term, round(0.6 * ln(tt.p) + 0.4 * ln(tt.p / pw.pw), 10) AS relevance
        FROM tt JOIN pw USING (term) WHERE tt.p > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY relevance DESC, term) AS rk FROM rel)
SELECT topic, CAST(rk AS INTEGER) AS "rank", term, round(relevance, 6) AS relevance FROM ranked WHERE rk <= 30""",
        "topic_distance": f"""WITH {PROXY},
topics AS (SELECT DISTINCT topic FROM tt),
pairs AS (SELECT a.topic AS ta, b.topic AS tb FROM topics a JOIN topics b ON a.topic < b.topic),
sa AS (SELECT ta, tb, term, p AS pa FROM tt JOIN pairs ON tt.topic = pairs.ta),
sb AS (SELECT ta, tb, term, p AS pb FROM tt JOIN pairs ON tt.topic = pairs.tb),
j AS (SELECT coalesce(sa.ta, sb.ta) AS ta, coalesce(sa.tb, sb.tb) AS tb, coalesce(pa, 0) AS pa, coalesce(pb, 0) AS pb
      FROM sa FULL JOIN sb ON sa.ta = sb.ta AND sa.tb = sb.tb AND sa.term = sb.term)
SELECT ta AS topic_a, tb AS topic_b, round(0.5 * sum(
    CASE WHEN pa > 0 THEN pa * ln(pa / ((pa + pb) / 2)) ELSE 0 END +
    CASE WHEN pb > 0 THEN pb * ln(pb / ((pa + pb) / 2)) ELSE 0 END), 6) AS jsd FROM j GROUP BY ta, tb""",
        "u_mass": f"WITH {_coherence(20)} SELECT topic, round(coherence, 6) AS coherence FROM coh",
        "u_mass_wide": f"WITH {_coherence(100)} SELECT topic, round(coherence, 6) AS coherence FROM coh",
        "coherence_models": " UNION ALL ".join(
            f"SELECT {n} AS model, * FROM (WITH {_coherence(n)} SELECT round(avg(coherence), 6) AS coherence FROM coh)"
            for n in (5, 10, 20)),
    }


# ---------------------------------------------------------------------------
# Clusters, visual words, scaling
# ---------------------------------------------------------------------------

LONG = """emb AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
long AS (SELECT vec_id, label, CAST(i AS INTEGER) AS dim, v[i + 1] AS x FROM emb CROSS JOIN range(0, 64) r(i))"""

DESC = f"""{LONG},
dsc AS (SELECT vec_id AS image_id, CAST(dim // 8 AS INTEGER) AS desc_ix, dim % 8 AS k, x FROM long),
cent AS (SELECT CAST(image_id * 8 + desc_ix AS INTEGER) AS word_id, k, x AS c FROM dsc WHERE image_id < 4),
dist AS (SELECT d.image_id, d.desc_ix, c.word_id, round(sum((d.x - c.c) * (d.x - c.c)), 9) AS dist
         FROM dsc d JOIN cent c ON d.k = c.k GROUP BY d.image_id, d.desc_ix, c.word_id),
assigned AS (SELECT image_id, desc_ix, word_id, dist FROM (
    SELECT *, row_number() OVER (PARTITION BY image_id, desc_ix ORDER BY dist, word_id) AS rn FROM dist) WHERE rn = 1),
hist AS (SELECT image_id, word_id, count(*) AS cnt FROM assigned GROUP BY image_id, word_id)"""

CLUSTERED = f"""{LONG},
means AS (SELECT label, dim, avg(x) AS m FROM long GROUP BY label, dim),
d AS (SELECT l.vec_id, CAST(m.label AS INTEGER) AS word_id, round(sum((l.x - m.m) * (l.x - m.m)), 9) AS dist
      FROM long l JOIN means m ON l.dim = m.dim GROUP BY l.vec_id, m.label),
cl AS (SELECT vec_id, word_id AS cluster FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, word_id) AS rn FROM d) WHERE rn = 1),
lab AS (SELECT vec_id, label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_code FROM embeddings),
pts AS (SELECT lab.label_code, cl.cluster FROM lab JOIN cl USING (vec_id)),
cont AS (SELECT label_code, cluster, count(*) AS n FROM pts GROUP BY label_code, cluster),
pur AS (SELECT *, n / sum(n) OVER (PARTITION BY cluster) AS purity FROM cont),
best AS (SELECT cluster, label_code AS best, purity FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY purity DESC, label_code) AS r FROM pur) WHERE r = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY best ORDER BY purity DESC, cluster) AS w FROM best),
winners AS (SELECT cluster, best AS label_code FROM ranked WHERE w = 1),
missing AS (SELECT DISTINCT label_code FROM cont WHERE label_code NOT IN (SELECT label_code FROM winners)),
mapping AS (SELECT cluster, label_code FROM winners UNION ALL
            SELECT cluster, coalesce((SELECT min(label_code) FROM missing), best) FROM ranked WHERE w > 1),
matched AS (SELECT p.label_code, m.label_code AS matched FROM pts p LEFT JOIN mapping m USING (cluster)),
mcont AS (SELECT label_code, matched, count(*) AS n FROM matched GROUP BY label_code, matched)"""


def _ari(table: str, col: str) -> str:
    return f"""(SELECT CASE WHEN den = 0 THEN 1.0 ELSE (i - e) / den END FROM (
    SELECT i, e, (a + b) / 2 - e AS den FROM (
      SELECT (SELECT sum(n::DOUBLE * (n - 1) / 2) FROM {table}) AS i,
             (SELECT sum(s::DOUBLE * (s - 1) / 2) FROM (SELECT sum(n) AS s FROM {table} GROUP BY label_code)) AS a,
             (SELECT sum(s::DOUBLE * (s - 1) / 2) FROM (SELECT sum(n) AS s FROM {table} GROUP BY {col})) AS b,
             (SELECT sum(s::DOUBLE * (s - 1) / 2) FROM (SELECT sum(n) AS s FROM {table} GROUP BY label_code))
           * (SELECT sum(s::DOUBLE * (s - 1) / 2) FROM (SELECT sum(n) AS s FROM {table} GROUP BY {col}))
           / (SELECT sum(n)::DOUBLE * (sum(n) - 1) / 2 FROM {table}) AS e)))"""


CORRELATIONS = f"""{LONG},
cor AS MATERIALIZED (SELECT a.dim AS i, b.dim AS j, corr(a.x, b.x) AS r FROM long a JOIN long b USING (vec_id) GROUP BY a.dim, b.dim)"""


def _lloyd(steps: int) -> str:
    """Two starts followed through ``steps`` iterations; an emptied centre stays."""
    ctes = [LONG, """c0 AS (SELECT 0 AS start, CAST(label AS INTEGER) AS cluster, dim, avg(x) AS m FROM long GROUP BY label, dim
    UNION ALL SELECT 1, CAST(vec_id AS INTEGER), dim, x FROM long WHERE vec_id < (SELECT count(DISTINCT label) FROM embeddings))"""]
    for i in range(steps + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (SELECT start, vec_id, arg_min(cluster, dist) AS cluster FROM (
    SELECT start, vec_id, cluster, sum((x - m) * (x - m)) AS dist FROM long JOIN c{i} USING (dim)
    GROUP BY start, vec_id, cluster) GROUP BY start, vec_id)""")
        if i < steps:
            ctes.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.start, c.cluster, c.dim, coalesce(n.m, c.m) AS m FROM c{i} c LEFT JOIN (
    SELECT start, cluster, dim, avg(x) AS m FROM a{i} JOIN long USING (vec_id) GROUP BY start, cluster, dim) n
    USING (start, cluster, dim))""")
    return f"""WITH {", ".join(ctes)}
SELECT start, cluster, coalesce(n, 0)::BIGINT AS n, dim, round(m, 6) AS v FROM c{steps}
LEFT JOIN (SELECT start, cluster, count(*) AS n FROM a{steps} GROUP BY start, cluster) USING (start, cluster)"""


def _dictionary(batches: int) -> str:
    """Mini-batch steps from the fixed dictionary: a centre moves to the running mean of what it has been given."""
    ctes = [LONG, """dsc AS (SELECT vec_id AS image_id, CAST(dim // 8 AS INTEGER) AS desc_ix, CAST(dim % 8 AS INTEGER) AS dim, x FROM long)""",
            "c0 AS (SELECT CAST(image_id * 8 + desc_ix AS INTEGER) AS word_id, 0 AS seen, dim, x AS v FROM dsc WHERE image_id < 4)"]
    for i in range(batches):
        ctes.append(f"""a{i} AS MATERIALIZED (SELECT image_id, desc_ix, arg_min(word_id, dist) AS word_id FROM (
    SELECT image_id, desc_ix, word_id, sum((x - v) * (x - v)) AS dist FROM dsc JOIN c{i} USING (dim)
    WHERE image_id % {batches} = {i} GROUP BY image_id, desc_ix, word_id) GROUP BY image_id, desc_ix)""")
        ctes.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.word_id, c.seen + coalesce(n, 0) AS seen, c.dim,
    coalesce((c.v * c.seen + s) / (c.seen + n), c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT word_id, dim, count(*) AS n, sum(x) AS s FROM a{i} JOIN dsc USING (image_id, desc_ix) GROUP BY word_id, dim)
    USING (word_id, dim))""")
    return f"WITH {', '.join(ctes)} SELECT word_id, seen::BIGINT AS seen, dim, round(v, 6) AS v FROM c{batches}"


def _clusters() -> dict[str, str]:
    wide = ", ".join(f"coalesce(max(CASE WHEN h.word_id = {i} THEN h.cnt END), 0) AS w{i}" for i in range(32))
    return {
        "label_codes": "SELECT label, vec_id, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_code "
                       "FROM embeddings",
        "standard_scale": f"""WITH {LONG},
st AS (SELECT dim, avg(x) AS m, stddev_samp(x) AS s FROM long GROUP BY dim)
SELECT vec_id AS id, dim, round(CASE WHEN st.s > 0 THEN (x - st.m) / st.s ELSE 0 END, 6) AS value
FROM long JOIN st USING (dim)""",
        "covariance": f"""WITH {LONG}
SELECT a.dim AS dim_i, b.dim AS dim_j, round(covar_samp(a.x, b.x), 6) AS cov
FROM long a JOIN long b ON a.vec_id = b.vec_id AND a.dim <= b.dim GROUP BY a.dim, b.dim""",
        "nearest_centroid": f"WITH {DESC} SELECT image_id, desc_ix, word_id, round(dist, 6) AS dist FROM assigned",
        "bovw_histogram": f"WITH {DESC} SELECT image_id, word_id, cnt FROM hist",
        "bovw_wide": f"WITH {DESC} SELECT e.vec_id AS image_id, {wide} FROM embeddings e "
                     "LEFT JOIN hist h ON h.image_id = e.vec_id GROUP BY e.vec_id",
        "bovw_tfidf": f"""WITH {DESC},
df AS (SELECT word_id, count(*) AS df FROM hist GROUP BY word_id),
raw AS (SELECT h.image_id, h.word_id, h.cnt * log2((SELECT count(*) FROM embeddings) / df.df) AS w
        FROM hist h JOIN df USING (word_id)),
nrm AS (SELECT *, sqrt(sum(w * w) OVER (PARTITION BY image_id)) AS nm FROM raw)
SELECT image_id, word_id, round(CASE WHEN nm > 0 THEN w / nm ELSE 0 END, 6) AS weight FROM nrm""",
        "top_descriptors": f"""WITH {LONG},
dsc AS (SELECT vec_id AS image_id, CAST(dim // 8 AS INTEGER) AS desc_ix, x FROM long),
en AS (SELECT image_id, desc_ix, round(sqrt(sum(x * x)), 9) AS energy FROM dsc GROUP BY image_id, desc_ix)
SELECT image_id, desc_ix, round(energy, 6) AS energy FROM (
  SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY energy DESC, desc_ix) AS r FROM en) WHERE r <= 3""",
        "confusion_matrix": f"WITH {CLUSTERED} SELECT label_code, cluster, n FROM cont",
        "purity_matrix": f"WITH {CLUSTERED} SELECT label_code, cluster, n, round(purity, 6) AS purity FROM pur",
        "match_clusters": f"WITH {CLUSTERED} SELECT cluster, CAST(label_code AS INTEGER) AS label_code FROM mapping",
        "adjusted_rand_index": f"WITH {CLUSTERED} SELECT round({_ari('mcont', 'matched')}, 6) AS ari, "
                               f"round({_ari('cont', 'cluster')}, 6) AS raw_ari",
        "evaluate_clusters": f"WITH {CLUSTERED} SELECT label_code, matched, n FROM mcont",
        "pca_spectrum": f"""WITH {CORRELATIONS}
SELECT 'power 1' AS measure, round(sum(r), 5) AS value FROM cor WHERE i = j
UNION ALL SELECT 'power 2', round(sum(r * r), 5) FROM cor
UNION ALL SELECT 'power 3', round(sum(a.r * b.r * c.r), 5) FROM cor a JOIN cor b ON a.j = b.i JOIN cor c ON b.j = c.i AND c.j = a.i
UNION ALL SELECT 'orthogonality', 0.0::DOUBLE UNION ALL SELECT 'projection', 0.0::DOUBLE""",
        "explained_variance": f"""WITH {CORRELATIONS}
SELECT (SELECT count(DISTINCT i) FROM cor) AS components, 1.0::DOUBLE AS whole,
       round(sum(r * r) / power((SELECT count(DISTINCT i) FROM cor), 2), 8) AS concentration FROM cor""",
        "descriptor_cells": f"""WITH {LONG},
px AS (SELECT vec_id, dim // 8 AS y, dim % 8 AS x, floor(255.0::DOUBLE * (x - mn) / (mx - mn)) AS v FROM (
    SELECT *, min(x) OVER (PARTITION BY vec_id) AS mn, max(x) OVER (PARTITION BY vec_id) AS mx FROM long) t),
g AS (SELECT *, CASE WHEN y = 0 THEN below - v WHEN y = 7 THEN v - above ELSE (below - above) / 2 END AS gy,
                CASE WHEN x = 0 THEN rightv - v WHEN x = 7 THEN v - leftv ELSE (rightv - leftv) / 2 END AS gx FROM (
    SELECT *, lag(v) OVER (PARTITION BY vec_id, x ORDER BY y) AS above, lead(v) OVER (PARTITION BY vec_id, x ORDER BY y) AS below,
              lag(v) OVER (PARTITION BY vec_id, y ORDER BY x) AS leftv, lead(v) OVER (PARTITION BY vec_id, y ORDER BY x) AS rightv FROM px)),
o AS (SELECT vec_id, (y // 4) * 2 + x // 4 AS cell, sqrt(gx * gx + gy * gy) / 255.0::DOUBLE AS mag,
             CASE WHEN atan2(gy, gx) < 0 THEN atan2(gy, gx) + 2 * pi() ELSE atan2(gy, gx) END AS ang FROM g),
b AS (SELECT vec_id, cell, least(floor(ang / (2 * pi()) * 8 + 1e-9::DOUBLE), 7)::INTEGER AS bin, sum(mag) AS m FROM o GROUP BY ALL),
c AS (SELECT vec_id, cell, sum(m) AS energy, sqrt(sum(m * m)) AS nm FROM b GROUP BY ALL),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY cell) - 1 AS INTEGER) AS desc_ix FROM c WHERE energy / 16 >= 0.04)
SELECT k.vec_id AS image_id, desc_ix, round(energy, 5) AS energy, CAST(r.i AS INTEGER) AS bin,
       round(CASE WHEN nm > 0 THEN coalesce(b.m, 0) / nm ELSE 0 END::FLOAT::DOUBLE, 5) AS v
FROM k CROSS JOIN range(0, 8) r(i) LEFT JOIN b ON b.vec_id = k.vec_id AND b.cell = k.cell AND b.bin = r.i""",
        "wide_to_vector": "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS size, "
                          "round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm FROM embeddings",
        "label_count": "SELECT count(DISTINCT label) AS n_labels FROM embeddings",
        "confusion_square": f"""WITH {CLUSTERED}, code AS (SELECT label_code AS c FROM cont UNION SELECT cluster FROM cont)
SELECT CAST(a.c AS INTEGER) AS label_code, CAST(b.c AS INTEGER) AS cluster, coalesce(n, 0) AS n FROM code a CROSS JOIN code b
LEFT JOIN cont ON cont.label_code = a.c AND cont.cluster = b.c""",
        "table_roundtrip": "SELECT p_partkey AS business_id, p_name AS categories FROM part",
        "photo_meta_json": "SELECT CAST(vec_id AS VARCHAR) AS photo_id, CAST(label AS VARCHAR) AS label, "
                           "'/data/photos/' || vec_id || '.jpg' AS photo_path FROM embeddings",
        "list_photo_files": "SELECT vec_id || '.png' AS file_name, CAST(vec_id AS VARCHAR) AS photo_id FROM embeddings "
                            "UNION ALL SELECT 'corrupt.png', 'corrupt'",
        "kmeans_steps": _lloyd(4),
        "dictionary_steps": _dictionary(3),
    }


# ---------------------------------------------------------------------------
# Type suggestion (lineitem)
# ---------------------------------------------------------------------------

LINEITEM_TYPES = [("l_orderkey", "BIGINT"), ("l_partkey", "BIGINT"), ("l_suppkey", "BIGINT"),
                  ("l_linenumber", "INT"), ("l_quantity", "DOUBLE"), ("l_extendedprice", "DOUBLE"),
                  ("l_discount", "DOUBLE"), ("l_tax", "DOUBLE"), ("l_returnflag", "STRING"),
                  ("l_linestatus", "STRING"), ("l_shipdate", "TIMESTAMP")]
_NP = {"BIGINT": "int64", "INT": "int32", "DOUBLE": "float64"}


def _suggest_types() -> str:
    parts = []
    for i, (c, t) in enumerate(LINEITEM_TYPES):
        head = f"SELECT CAST({i} AS INTEGER) AS ordinal, '{c}' AS column_name, '{t}' AS current_type"
        if t == "STRING":
            ts = (f"(SELECT coalesce(bool_and(coalesce(regexp_matches({c}, {_q(TX.TIMESTAMP_PREFIX_PATTERN)}), true)), true) "
                  "FROM lineitem)")
            parts.append(f"{head}, CASE WHEN {ts} THEN 'datetime64[ns]' ELSE 'category' END AS numpy_type, "
                         f"CASE WHEN {ts} THEN 'TIMESTAMP' ELSE 'CATEGORY' END AS suggested_type")
            continue
        if t == "TIMESTAMP":
            parts.append(f"{head}, 'datetime64[ns]' AS numpy_type, 'TIMESTAMP' AS suggested_type")
            continue
        is_float = t == "DOUBLE"
        ii = f"coalesce(bool_and({c} = floor({c})), true)" if is_float else "true"
        # a candidate type wins only if strictly smaller than the best so far, in the order
        # unsigned, signed, float32; exact float32 matters for 8-byte columns alone
        ff = (f"coalesce(bool_and(CAST(CAST({c} AS FLOAT) AS DOUBLE) = {c}), true)"
              if t in ("DOUBLE", "BIGINT") else "false")
        stats = (f"(SELECT min({c})::DOUBLE AS mn, max({c})::DOUBLE AS mx, count(*) FILTER (WHERE {c} IS NULL) AS nn, "
                 f"{ii} AS ii, {ff} AS ff FROM lineitem)")
        signed_sp = ("CASE WHEN mn >= -128 AND mx <= 127 THEN 'TINYINT' WHEN mn >= -32768 AND mx <= 32767 THEN 'SMALLINT' "
                     "WHEN mn >= -2147483648 AND mx <= 2147483647 THEN 'INT' ELSE 'BIGINT' END")
        keep = _NP[t]
        own = {"DOUBLE": 8, "BIGINT": 8, "INT": 4, "FLOAT": 4, "SMALLINT": 2, "TINYINT": 1}[t]
        uw = "CASE WHEN NOT ii OR mn < 0 THEN 99 WHEN mx <= 255 THEN 1 WHEN mx <= 65535 THEN 2 WHEN mx <= 4294967295 THEN 4 ELSE 8 END"
        sw = ("CASE WHEN NOT ii THEN 99 WHEN mn >= -128 AND mx <= 127 THEN 1 WHEN mn >= -32768 AND mx <= 32767 THEN 2 "
              "WHEN mn >= -2147483648 AND mx <= 2147483647 THEN 4 ELSE 8 END")
        fw = "CASE WHEN ff THEN 4 ELSE 99 END"
        numpy = (f"CASE WHEN least({uw}, {sw}, {fw}) >= {own} THEN '{keep}' "
                 f"WHEN {uw} <= least({sw}, {fw}) THEN 'uint' || CAST(8 * {uw} AS VARCHAR) "
                 f"WHEN {sw} <= {fw} THEN 'int' || CAST(8 * {sw} AS VARCHAR) ELSE 'float32' END")
        float_sp = f"CASE WHEN ff AND {str(is_float).lower()} THEN 'FLOAT' ELSE '{t}' END"
        parts.append(
            f"{head}, CASE WHEN nn > 0 THEN '{keep}' WHEN mn IS NULL THEN '{keep}' "
            f"ELSE {numpy} END AS numpy_type, "
            f"CASE WHEN nn > 0 THEN '{t}' WHEN mn IS NULL THEN '{t}' WHEN ii THEN {signed_sp} ELSE {float_sp} END "
            f"AS suggested_type FROM {stats}")
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------------------
# Images (8 x 8 patches from embeddings)
# ---------------------------------------------------------------------------

GRAY = """emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
gray AS (SELECT vec_id AS image_id, CAST(i AS INTEGER) AS i,
         CAST(floor(255.0 * (v[i + 1] - list_min(v)) / (list_max(v) - list_min(v))) AS INTEGER) AS px
         FROM emb CROSS JOIN range(0, 64) r(i)),
color AS (SELECT g.image_id, CAST(j AS INTEGER) AS j, s.px
          FROM (SELECT DISTINCT image_id FROM gray) g CROSS JOIN range(0, 192) r(j)
          JOIN gray s ON s.image_id = g.image_id AND s.i = ((j // 3) + (j % 3) * 21) % 64)"""


def _dbl(x: float) -> str:
    return f"'{x!r}'::DOUBLE"


def _images() -> dict[str, str]:
    # kernel width 3: sigma = 0.3 * ((3 - 1) / 2 - 1) + 0.8 = 0.8, so 2 sigma^2 = 1.28
    stencil = ", ".join(f"({dy}, {dx}, exp(-{dy * dy + dx * dx} / 1.28::DOUBLE) / "
                        "(1 + 4 * exp(-1 / 1.28::DOUBLE) + 4 * exp(-2 / 1.28::DOUBLE)))" for dy in (-1, 0, 1) for dx in (-1, 0, 1))
    means = NETWORK_CHANNEL_MEANS

    def refl(e):
        return f"CASE WHEN {e} < 0 THEN -({e}) WHEN {e} >= 8 THEN 14 - ({e}) ELSE {e} END"

    return {
        "to_gray": f"""WITH {GRAY},
bgr AS (SELECT image_id, j // 3 AS p, max(CASE WHEN j % 3 = 0 THEN px END) AS b, max(CASE WHEN j % 3 = 1 THEN px END) AS g,
        max(CASE WHEN j % 3 = 2 THEN px END) AS r FROM color GROUP BY image_id, j // 3)
SELECT image_id, string_agg(CAST((r * 4899 + g * 9617 + b * 1868 + 8192) >> 14 AS VARCHAR), ',' ORDER BY p) AS pixels
FROM bgr GROUP BY image_id""",
        "equalize_hist": f"""WITH {GRAY},
lv AS (SELECT image_id, px AS v, count(*) AS h FROM gray GROUP BY image_id, px),
cdf AS (SELECT image_id, v, sum(h) OVER (PARTITION BY image_id ORDER BY v ROWS UNBOUNDED PRECEDING) AS cdf,
        sum(h) OVER (PARTITION BY image_id) AS total, arg_min(h, v) OVER (PARTITION BY image_id) AS h0 FROM lv),
lut AS (SELECT image_id, v, CAST(CASE WHEN total = h0 THEN v ELSE round((cdf - h0) * 255.0 / (total - h0)) END AS INTEGER)
        AS v_eq FROM cdf)
SELECT g.image_id, CAST(g.i // 8 AS INTEGER) AS y, CAST(g.i % 8 AS INTEGER) AS x, lut.v_eq AS v
FROM gray g JOIN lut ON lut.image_id = g.image_id AND lut.v = g.px""",
        "gaussian_blur": f"""WITH {GRAY},
px AS (SELECT image_id, i // 8 AS y, i % 8 AS x, px AS v FROM gray),
st(dy, dx, w) AS (VALUES {stencil}),
o AS (SELECT px.image_id, px.y, px.x, st.w, {refl('px.y + st.dy')} AS sy, {refl('px.x + st.dx')} AS sx FROM px, st)
SELECT o.image_id, CAST(o.y AS INTEGER) AS y, CAST(o.x AS INTEGER) AS x, round(sum(o.w * s.v), 6) AS v
FROM o JOIN px s ON s.image_id = o.image_id AND s.y = o.sy AND s.x = o.sx GROUP BY o.image_id, o.y, o.x""",
        "swap_channels": f"""WITH {GRAY}
SELECT c.image_id, string_agg(CAST(s.px AS VARCHAR), ',' ORDER BY c.j) AS pixels
FROM color c JOIN color s ON s.image_id = c.image_id AND s.j = c.j - (c.j % 3) + (2 - (c.j % 3)) GROUP BY c.image_id""",
        "resize_nearest": f"""WITH {GRAY}
SELECT g.image_id, string_agg(CAST(s.px AS VARCHAR), ',' ORDER BY o) AS pixels
FROM (SELECT DISTINCT image_id FROM gray) g CROSS JOIN range(0, 25) r(o)
JOIN gray s ON s.image_id = g.image_id AND s.i = ((o // 5) * 8 // 5) * 8 + ((o % 5) * 8 // 5) GROUP BY g.image_id""",
        "center_channels": f"""WITH {GRAY}
SELECT image_id, j AS i, round(px::DOUBLE - CASE j % 3 WHEN 0 THEN {_dbl(means[0])} WHEN 1 THEN {_dbl(means[1])}
       ELSE {_dbl(means[2])} END, 6) AS v FROM color""",
    }


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for part in (_sources(), _text(), _vectors(), _topics(), _clusters(), _images()):
        out.update(part)
    out["load_images"] = f"""WITH {GRAY} SELECT CAST(image_id AS VARCHAR) AS image_id, CAST(8 AS INTEGER) AS height,
        CAST(8 AS INTEGER) AS width, CAST(1 AS INTEGER) AS n_channels,
        string_agg(CAST(px AS VARCHAR), ',' ORDER BY i) AS pixels FROM gray GROUP BY image_id"""
    # the stand-in network's weight table by its formula
    out["embed_images"] = f"""WITH {GRAY}, unit AS (
            SELECT image_id, j, greatest(0, sum(px * ((7 * i + 13 * j) % 11 - 5))) AS v
            FROM gray CROSS JOIN range(0, 16) r(j) GROUP BY image_id, j)
        SELECT image_id, string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY j) AS embedding
        FROM unit GROUP BY image_id"""
    out["doc_topic_mass"] = f"""WITH {_tfidf_cte()} SELECT d.doc_id,
        CASE WHEN count(t.term_id) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS mass
        FROM documents d LEFT JOIN tfidf t ON t.doc_id = d.doc_id GROUP BY d.doc_id"""
    out["suggest_types"] = _suggest_types()
    return {k: v.strip() for k, v in out.items()}

