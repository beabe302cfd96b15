"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from ledgerloom.llm import orchard, positional_index
from ledgerloom.llm.jaccard_join import SHINGLE_WORDS, THRESHOLD
from ledgerloom.llm.mixing import MAX_REPEATS, SCHEDULES, WEIGHTS
from ledgerloom.llm.url_filter import LOWER, RULES, VOCABULARY

_SPACES = r"[\x20\x09-\x0D]+"
_WORDS = r"[^\x20\x09-\x0D]+"


def _url_filter_sql() -> str:
    upper, lower = "".join(map(chr, LOWER)), "".join(map(chr, LOWER.values()))

    def stands_alone(term: str) -> str:
        return f"regexp_matches(low, '(^|[^a-z0-9]){term}($|[^a-z0-9])')"

    def fits(rule) -> str:
        return (
            f"((host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}'))"
        )

    longest_first = sorted(RULES, key=lambda r: (-len(r.text), -len(r.host)))
    rule = " ".join(f"WHEN {fits(r)} THEN '{r.text}'" for r in longest_first)
    allowed = ", ".join(f"'{r.text}'" for r in RULES if r.allow)
    # a term may stand between two boundaries that it shares with its neighbour: count the gaps doubled
    doubled = "regexp_replace(low, '([^a-z0-9])', '\\1\\1', 'g')"
    strict = " + ".join(
        f"len(regexp_extract_all({doubled}, '(^|[^a-z0-9]){t}($|[^a-z0-9])'))" for t in VOCABULARY.strict
    )
    soft = " + ".join(f"CASE WHEN {stands_alone(t)} THEN 1 ELSE 0 END" for t, _ in VOCABULARY.soft)
    weight = " + ".join(f"CASE WHEN {stands_alone(t)} THEN {w}::DOUBLE ELSE 0.0::DOUBLE END" for t, w in VOCABULARY.soft)
    return f"""
    WITH cut AS (
      SELECT page_id, coalesce(url, '') AS url, strpos(url, '://') AS mark FROM pages
    ), rest AS (
      SELECT page_id, url, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS tail FROM cut
    ), parts AS (
      SELECT page_id, translate(url, '{upper}', '{lower}') AS low,
             translate(regexp_extract(tail, '^([^/?#]*)', 1), '{upper}', '{lower}') AS host,
             regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path
      FROM rest
    ), counted AS (
      SELECT page_id, host, path, CASE {rule} END AS rule,
             CAST({strict} AS BIGINT) AS strict_hits, CAST({soft} AS BIGINT) AS soft_terms, {weight} AS soft_weight
      FROM parts
    )
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ({allowed}) THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                WHEN strict_hits > 0 OR (soft_terms >= {VOCABULARY.min_soft} AND soft_weight >= {VOCABULARY.min_weight})
                THEN 'block' ELSE 'allow' END AS verdict,
           strict_hits, soft_terms, soft_weight
    FROM counted
    """


# all pairs of different shingle sets that share a shingle, and classes by closure over the links
_SIMILAR = f"""
WITH RECURSIVE cut AS MATERIALIZED (
  SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(lower(coalesce(text, '')), '{_WORDS}') AS words FROM documents
), shingled AS MATERIALIZED (
  SELECT place, doc_id, list_sort(list_distinct(CASE WHEN len(words) < {SHINGLE_WORDS} THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - {SHINGLE_WORDS - 2}), lambda i: array_to_string(words[i:i + {SHINGLE_WORDS - 1}], ' ')) END)) AS found
  FROM cut WHERE len(words) > 0
), keyed AS MATERIALIZED (
  SELECT place, doc_id, md5(array_to_string(found, chr(10))) AS node, len(found) AS size, found FROM shingled
), sets AS MATERIALIZED (
  SELECT node, any_value(size) AS size, any_value(found) AS found, count(*) AS copies FROM keyed GROUP BY node
), elements AS MATERIALIZED (SELECT node, size, unnest(found) AS shingle FROM sets
), shared AS (
  SELECT a.node AS a, b.node AS b, any_value(a.size) AS size_a, any_value(b.size) AS size_b, count(*) AS common
  FROM elements a JOIN elements b ON a.shingle = b.shingle AND a.node <> b.node
    AND least(a.size, b.size) >= {THRESHOLD} * greatest(a.size, b.size) - 1e-9
  GROUP BY a.node, b.node
), links AS MATERIALIZED (
  SELECT a, b FROM shared WHERE common >= {THRESHOLD} * (size_a + size_b - common) - 1e-9
), reached AS (
  SELECT node, node AS other FROM sets UNION SELECT reached.node, links.b FROM reached JOIN links ON reached.other = links.a
), classes AS MATERIALIZED (SELECT node, min(other) AS root FROM reached GROUP BY node
), linked AS (SELECT a AS node, sum(copies) AS links FROM links JOIN sets ON links.b = sets.node GROUP BY a
), placed AS (
  SELECT doc_id, sets.copies, coalesce(links, 0) AS links, count(*) OVER whole AS class_size, min(doc_id) OVER whole AS class_id,
    row_number() OVER (PARTITION BY root ORDER BY doc_id NULLS LAST, place) = 1 AS kept
  FROM keyed JOIN classes USING (node) JOIN sets USING (node) LEFT JOIN linked USING (node)
  WINDOW whole AS (PARTITION BY root)
)
SELECT doc_id, class_id, class_size, CAST(links + copies - 1 AS BIGINT) AS n_links, kept FROM placed
UNION ALL SELECT doc_id, doc_id, 1, 0, true FROM cut WHERE len(words) = 0
"""


_EXACT_DEDUP = f"""
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACES}', ' ', 'g')) AS text_sha256 FROM documents
), grouped AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY 1
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM hashed JOIN grouped USING (text_sha256)
"""


def _time_sql(share: str, corners) -> str:
    total = sum((w0 + w1) * (t1 - t0) / 2 for (t0, w0), (t1, w1) in zip(corners, corners[1:]))
    whens, start = [], 0.0
    for (t0, w0), (t1, w1) in zip(corners, corners[1:]):
        end, slope = start + (w0 + w1) * (t1 - t0) / 2, (w1 - w0) / (t1 - t0)
        inside = f"({share} * {total}::DOUBLE - {start}::DOUBLE)"
        root = f"sqrt(greatest({w0 * w0}::DOUBLE + {2 * slope}::DOUBLE * {inside}, 0))"
        whens.append(
            f"WHEN {share} * {total}::DOUBLE < {end}::DOUBLE "
            f"THEN least({t0}::DOUBLE + 2 * {inside} / ({w0}::DOUBLE + {root}), {t1}::DOUBLE)"
        )
        start = end
    return f"CASE {' '.join(whens)} ELSE {corners[-1][0]}::DOUBLE END"


def _mix_sql() -> str:
    weight = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))
    taken = " + ".join(
        f"greatest(least(size, whole - (source_size * {r} + before)), 0)" for r in range(MAX_REPEATS)
    )
    time = " ".join(f"WHEN {i} THEN {_time_sql('share', c)}" for i, c in enumerate(SCHEDULES))
    return f"""
    WITH sized AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORDS}')) AS size,
             md5(coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS digest
      FROM documents
    ), sources AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place
      FROM sized GROUP BY source
    ), weighed AS (
      SELECT *, {MAX_REPEATS} * source_size AS most, CASE place % {len(WEIGHTS)} {weight} END AS weight FROM sources
    ), stepped AS (
      SELECT *, ((SELECT sum(source_size) FROM weighed)
                 - coalesce(sum(most) OVER (ORDER BY most::DOUBLE / weight, place
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                / sum(weight) OVER (ORDER BY most::DOUBLE / weight, place
                                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
      FROM weighed
    ), filled AS (
      SELECT max(level) AS level FROM stepped
    ), targets AS (
      SELECT source, source_size, place,
             CASE WHEN most < weight * (SELECT level FROM filled) THEN most::DOUBLE
                  ELSE weight * (SELECT level FROM filled) END AS target
      FROM weighed
    ), laid AS (
      SELECT doc_id, size, source_size, target, place, CAST(floor(target) AS BIGINT) AS whole,
             coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY digest, doc_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
    ), used AS (
      SELECT *, (before + greatest(least(size, whole - before), 0) / 2) / target AS share FROM laid
    )
    SELECT doc_id, size, source_size, target, CAST({taken} AS BIGINT) AS taken,
           CASE WHEN least(size, whole - before) > 0
                THEN round(CASE place % {len(SCHEDULES)} {time} END, 9) END AS first_position
    FROM used
    """


def _positional_index_sql() -> str:
    upper, lower = "".join(map(chr, LOWER)), "".join(map(chr, LOWER.values()))
    window = positional_index.WINDOW

    def words(text: str) -> str:
        return f"regexp_extract_all(translate(coalesce({text}, ''), '{upper}', '{lower}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

    def windows(width: str) -> str:
        return f"list_transform(range(1, len(words) - {width} + 2), lambda i: {{'spot': i, 'words': array_to_string(words[i : i + {width} - 1], ' ')}})"

    return f"""
    WITH docs AS (
      SELECT doc_id, {words("text")} AS words FROM documents
    ), items AS (
      SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words("text")} AS words FROM benchmark
    ), wanted AS (
      SELECT DISTINCT item, width, w.words AS words
      FROM (SELECT item, width, unnest({windows("width")}) AS w
            FROM (SELECT *, least({window}, len(words)) AS width FROM items) WHERE width > 0)
    ), placed AS (
      SELECT doc_id, width, w.spot AS spot, w.words AS words
      FROM (SELECT doc_id, width, unnest({windows("width")}) AS w
            FROM docs, (SELECT DISTINCT width FROM wanted) WHERE len(docs.words) >= width)
    ), found AS (
      SELECT doc_id, item, spot, width FROM placed JOIN wanted USING (width, words)
    ), hit AS (
      SELECT doc_id, count(DISTINCT place) AS n_hit
      FROM (SELECT doc_id, unnest(range(spot, spot + width)) AS place FROM (SELECT DISTINCT doc_id, spot, width FROM found)) GROUP BY doc_id
    ), named AS (
      SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM found GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(docs.words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
           sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
    """


def _orchard_sql() -> str:
    parts = orchard.PARTS

    def assigned(turn: int) -> str:
        # the nearest entry of every part, the lowest of equals
        return f"""near{turn} AS MATERIALIZED (
      SELECT vec_id, p, arg_min({{'entry': entry, 'gap': gap, 'v': v}}, {{'gap': gap, 'entry': entry}}) AS best
      FROM (SELECT vec_id, part.p AS p, part.v AS v, entry,
                   list_sum(list_transform(list_zip(part.v, book.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS gap
            FROM part JOIN book{turn} AS book ON part.p = book.p)
      GROUP BY vec_id, p
    )"""

    def moved(turn: int) -> str:
        floor = "(total - ((total % rows) + rows) % rows) // rows"
        return f"""sum{turn} AS (
      SELECT p, entry, place, CAST({floor} AS BIGINT) AS mean
      FROM (SELECT p, best.entry AS entry, place, CAST(sum(x) AS BIGINT) AS total, count(*) AS rows
            FROM (SELECT p, best, unnest(best.v) AS x, unnest(range(len(best.v))) AS place FROM near{turn}) GROUP BY ALL)
    ), book{turn + 1} AS MATERIALIZED (
      SELECT book{turn}.p AS p, book{turn}.entry AS entry, coalesce(m.v, book{turn}.v) AS v
      FROM book{turn} LEFT JOIN (SELECT p, entry, list(mean ORDER BY place) AS v FROM sum{turn} GROUP BY p, entry) m USING (p, entry)
    )"""

    rounds = ", ".join(f"{assigned(r)}, {moved(r)}" for r in range(orchard.ROUNDS))
    return f"""
    WITH kept AS (
      SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({orchard.SCALE} * x::DOUBLE) AS BIGINT)) AS v
      FROM embeddings
      WHERE len(embedding) > 0 AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))
    ), part AS MATERIALIZED (
      SELECT vec_id, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS v FROM kept, range({parts}) AS r(p)
    ), book0 AS MATERIALIZED (
      SELECT p, entry, v FROM (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS entry FROM part)
      WHERE entry < {orchard.ENTRIES}
    ), {rounds}, {assigned(orchard.ROUNDS)}, coded AS (
      SELECT vec_id, string_agg(printf('%02x', best.entry), '' ORDER BY p) AS code, CAST(sum(best.gap) AS BIGINT) AS error
      FROM near{orchard.ROUNDS} GROUP BY vec_id
    ), digest AS (
      SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, entry)) AS codebooks_sha256 FROM book{orchard.ROUNDS}
    )
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM coded JOIN kept USING (vec_id), digest
    """


ORACLE: dict[str, str] = {
    "op3_url_filter": _url_filter_sql(),
    "op6_chosen_path": _SIMILAR,
    "op7_exact_dedup": _EXACT_DEDUP,
    "op10_curriculum_mix": _mix_sql(),
    "op12_positional_index": _positional_index_sql(),
    "op13_orchard_codes": _orchard_sql(),
}
