"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_HOST_AND_PATH = r"""
SELECT page_id, coalesce(url, '') AS url,
       CASE WHEN contains(coalesce(url, ''), '://')
            THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
       CASE WHEN contains(coalesce(url, ''), '://')
            THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
FROM pages"""

URL_FILTERS = rf"""
WITH p AS ({_HOST_AND_PATH}),
rules(action, rhost, rpath) AS (VALUES
    ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
r AS (SELECT p.*, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
       (SELECT min_by(struct_pack(rule := rhost || rpath, action := action), -length(rhost || rpath)) FROM rules
        WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS best
      FROM p),
m AS (SELECT *,
       regexp_matches(low, '(?s)^[^:/?#]*://(?:[^/?#]*\.)?spam-farm\..*/about(?:[^a-z0-9_.%-]|$)') AS about,
       regexp_matches(low, '(?s)^[^:/?#]*://(?:[^/?#]*\.)?spam-farm\.') AS spam,
       regexp_matches(low, '(?s)^[^:/?#]*://(?:[^/?#]*\.)?casino\.') AS casino,
       contains(low, '-casino-') AS casino_part,
       regexp_matches(low, '(?s)^[^:/?#]*://(?:[^/?#]*\.)?porn\.') AS porn,
       regexp_matches(low, '(?s)^[^:/?#]*://(?:[^/?#]*\.)?xxx\.') AS xxx,
       regexp_matches(low, '(?s)/viagra(?:[^a-z0-9_.%-]|$)') AS viagra,
       contains(low, '/adserver/') AS adserver,
       regexp_matches(low, '(?s)^[^:/?#]*://(?:[^/?#]*\.)?ads\..*/click(?:[^a-z0-9_.%-]|$)') AS ads,
       contains(low, '/wp-login.php') AS login,
       contains(low, '/phishing/') AS phishing
      FROM r),
n AS (SELECT *, CASE
       WHEN about THEN '||spam-farm.*/about^'
       WHEN ads THEN '||ads.*/click^'
       WHEN login THEN '/wp-login.php'
       WHEN spam THEN '||spam-farm.'
       WHEN adserver THEN '/adserver/'
       WHEN phishing THEN '/phishing/'
       WHEN casino THEN '||casino.'
       WHEN casino_part THEN '-casino-'
       WHEN viagra THEN '/viagra^'
       WHEN porn THEN '||porn.'
       WHEN xxx THEN '||xxx.' END AS pattern FROM m)
SELECT page_id, host, path, best.rule AS rule, pattern,
       coalesce(best.action, CASE WHEN pattern IS NULL OR pattern = '||spam-farm.*/about^' THEN 'allow' ELSE 'block' END) AS verdict
FROM n"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Words by position, 13-word windows, the smallest document of each window, covered words.
SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
firsts AS (SELECT k, min(doc_id) AS least FROM win GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, i + o AS i FROM win JOIN firsts USING (k) CROSS JOIN range(0, 13) r(o)
         WHERE doc_id > least),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(lost.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)"""


def quality_rules() -> str:
    """The base counts and the line rules; lists and limits come from the operator's parameters."""
    from .quality_rules import BOILERPLATE, CLOSING, NAVIGATION, Rules

    r = Rules()
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = f"translate(line, '{upper}', '{upper.lower()}')"
    phrases = " OR ".join(f"contains({low}, '{x}')" for x in BOILERPLATE)
    labels = ", ".join(f"'{x}'" for x in NAVIGATION)
    closing = ", ".join(map(str, CLOSING))
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + {r.repeat_width - 1}], ' ') AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {r.repeat_width - 2})) AS i FROM d)),
twice AS (SELECT doc_id, k FROM win GROUP BY doc_id, k HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM win JOIN twice USING (doc_id, k)
        CROSS JOIN range(0, {r.repeat_width}) s(o) GROUP BY doc_id),
split AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 unnest(range(0, len(string_split(text, chr(10))))) AS pos, len(string_split(text, chr(10))) AS lines FROM d),
l AS (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw FROM split),
m AS (SELECT *, len(lw) AS n,
        length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols,
        len(list_filter(lw, lambda x: x IN ('|', '>', '/', '»', '•', '·'))) AS bars,
        length(regexp_replace(line, '[^A-Za-z]', '', 'g')) AS letters,
        length(regexp_replace(line, '[^A-Z]', '', 'g')) AS uppers,
        len(list_filter(lw, lambda x: ends_with(x, '!!') OR ends_with(x, '??'))) AS marked,
        array_to_string(list_transform(lw, lambda x: translate(x, '{upper}', '{upper.lower()}')), ' ') AS flat
      FROM l WHERE len(lw) > 0),
f AS (SELECT doc_id, line, n, symbols > {r.max_symbols_per_word} * n
        OR (bars >= {r.min_separators} AND bars > {r.max_separator_share} * n)
        OR flat IN ({labels})
        OR (n >= {r.min_shout_words} AND letters > 0 AND uppers > {r.min_shout_share} * letters)
        OR (n >= 2 AND marked > {r.max_repeated_marks} * n)
        OR ({phrases})
        OR (n BETWEEN {r.min_unclosed_words} AND {r.max_unclosed_words} AND pos < lines - 1
            AND unicode(right(lw[-1], 1)) NOT IN ({closing})) AS failed FROM m),
g AS (SELECT doc_id, coalesce(sum(n) FILTER (WHERE failed), 0)::BIGINT AS lost,
             (count(*) - count(DISTINCT line))::BIGINT AS dups FROM f GROUP BY doc_id),
b AS (SELECT d.doc_id, len(w)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(dups, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        coalesce(lost, 0)::BIGINT AS n_lost_words
      FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN g USING (doc_id)),
c AS (SELECT *, n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words AS base_failed FROM b)
SELECT *, NOT base_failed AND n_lost_words <= {r.max_lost} * n_words AS kept FROM c"""


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

RANKED_SEARCH = rf"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
tot AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS terms FROM d WHERE len(w) > 0),
q AS (SELECT item_id, t, count(*)::BIGINT AS times
      FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark WHERE text IS NOT NULL) GROUP BY item_id, t),
p AS (SELECT doc_id, t, n, count(*)::BIGINT AS tf FROM (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS t FROM d)
      WHERE t IN (SELECT t FROM q) GROUP BY doc_id, t, n),
f AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
      FROM p, tot GROUP BY t, docs),
s AS (SELECT item_id, doc_id,
             sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))))::BIGINT AS score
      FROM p JOIN f USING (t) JOIN q USING (t), tot GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM s WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM r WHERE place <= 10"""

FILL_IN_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
                  sha256('1:' || doc_id) AS s FROM documents),
h AS (SELECT doc_id, text, w, len(w) AS n, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2,
             ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
                  THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
x AS (SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle,
             array_to_string(w[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM x"""

SQL: dict[str, str] = {"op3_quality_rules": quality_rules(), "op6_substring_dedup": SUBSTRING_DEDUP,
                       "op8_url_filters": URL_FILTERS, "op11_ranked_search": RANKED_SEARCH,
                       "op12_fill_in_middle": FILL_IN_MIDDLE}
