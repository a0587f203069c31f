"""DuckDB twins of the adapter views, and a helper that prefixes a query with
the views it uses as CTEs (the oracle only has the raw driver tables)."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "songs": """
SELECT upper(substr(sha1(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)),1,16)) AS song_id,
       p_name AS title, s_name AS artist, l_suppkey AS artist_id, l_orderkey AS album_id,
       30.0 + l_extendedprice % 240 AS tempo, -60.0 + l_quantity AS loudness,
       CAST(l_partkey % 12 AS INT) AS key, CAST(l_orderkey % 2 AS INT) AS mode,
       CAST(l_linenumber AS INT) AS time_signature, l_discount * 10 AS danceability,
       CAST(year(l_shipdate) AS INT) AS year, l_shipdate AS added_at
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey""",
    "catalog": """
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY song_id
           ORDER BY added_at, album_id, artist_id, tempo, loudness, danceability, title) AS _rn
  FROM songs) WHERE _rn = 1""",
    "song_attributes": """
SELECT upper(substr(sha1(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)),1,16)) AS song_id,
       min(60.0 + l_quantity * 5) AS duration, min(l_tax * 10) AS energy, min(l_extendedprice % 100 / 100) AS song_hotttnesss,
       min((s_acctbal + 1000) / 11000) AS artist_hotttnesss, min(CAST(s_suppkey % 181 - 90 AS DOUBLE)) AS latitude,
       min(CAST(s_suppkey % 361 - 180 AS DOUBLE)) AS longitude
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1""",
    "song_timbre": """
SELECT c.song_id, j, v.embedding[1:12] AS timbre
FROM catalog c JOIN range(3) r(j) ON j < c.time_signature % 4
JOIN vectors v ON v.vec_id = (c.album_id * 7 + c.artist_id + j) % (SELECT count(*) FROM embeddings)""",
    "timbre_stats": """
SELECT song_id, """ + ", ".join(f"coalesce(avg(t.timbre[{i + 1}]), 0) AS timbre_mean_{i}" for i in range(12)) + ", "
    + ", ".join(f"coalesce(stddev_pop(t.timbre[{i + 1}]), 0) AS timbre_std_{i}" for i in range(12)) + """
FROM catalog c LEFT JOIN song_timbre t USING (song_id) GROUP BY song_id""",
    "clean_songs": """
SELECT * EXCLUDE (danceability) FROM songs WHERE tempo BETWEEN 40 AND 250 AND time_signature BETWEEN 1 AND 5""",
    "clustered_songs": """
SELECT *, CAST((key * 7 + time_signature) % 11 AS INT) AS cluster_id FROM clean_songs""",
    "clustered_catalog": """
SELECT song_id, title, artist, tempo, key, mode, CAST((key * 7 + time_signature) % 11 AS INT) AS cluster_id FROM songs
WHERE tempo BETWEEN 40 AND 250 AND time_signature BETWEEN 1 AND 5""",
    "requests": """
SELECT upper(substr(sha1(concat_ws('-', event_type, event_id)),1,16)) AS recommendation_id, ts,
       concat(event_type,'#',event_id) AS track_name, concat('User#',user_id) AS artist_name,
       20.0 + value % 240 AS tempo, -60.0 + value % 60 AS loudness, CAST(user_id % 12 AS DOUBLE) AS key,
       CAST(event_id % 2 AS DOUBLE) AS mode, CAST(event_id % 7 AS DOUBLE) AS time_signature
FROM events WHERE event_type = 'view'""",
    "request_messages": """
SELECT upper(substr(sha1(concat_ws('-', event_type, event_id)),1,16)) AS key,
       CASE WHEN event_type = 'error' THEN '{bad'
            WHEN event_type = 'signup' THEN concat('{"track_name":"t', event_id, '","artist_name":"u', user_id, '"}')
            ELSE concat('{"track_name":"t', event_id, '","artist_name":"u', user_id, '","tempo":', 30 + event_id % 240,
                        ',"loudness":', -1 * (event_id % 60), ',"key":', CASE WHEN event_id % 97 = 0 THEN '1e12' ELSE CAST(user_id % 12 AS VARCHAR) END, ',"mode":', event_id % 2,
                        ',"time_signature":', event_id % 7, '}') END AS value
FROM events""",
    "api_payload": """
SELECT event_id, concat('{"title":"t', event_id, '","tempo":"', 30 + event_id % 240, '","key_of":"',
       CASE user_id % 6 WHEN 0 THEN 'C' WHEN 1 THEN 'F#m' WHEN 2 THEN 'B♭' WHEN 3 THEN 'E♯' WHEN 4 THEN '' ELSE 'Am' END,
       '","time_signature":"', CASE event_id % 3 WHEN 0 THEN '4/4' WHEN 1 THEN '3/4' ELSE 'x' END,
       '","acousticness":"', event_id % 101, '","artist":',
       CASE event_id % 2 WHEN 0 THEN concat('{"name":"u', user_id, '"}') ELSE concat('[{"name":"u', user_id, '"}]') END, '}') AS payload
FROM events""",
    "artists": """
SELECT s_suppkey AS artist_id, s_name AS name, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE sha1(s_name) END AS gid,
       (s_acctbal + 1000) / 11000 AS familiarity FROM supplier""",
    "artist_similarity": """
SELECT a.l_suppkey AS src, b.l_suppkey AS dst, count(*) AS weight
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey <> b.l_suppkey GROUP BY 1, 2""",
    "artist_terms": """
SELECT l_suppkey AS artist_id, p_brand AS term, count(*) AS freq FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2""",
    "mb_track": """
SELECT DISTINCT song_id AS id, CASE WHEN album_id % 3 = 0 THEN concat(title, ' [alt]') ELSE title END AS name,
       artist_id AS artist, album_id AS album FROM songs""",
    "mb_album": """
SELECT o_orderkey AS id, concat('Album#', o_orderkey % 97) AS name, o_custkey % (SELECT count(*) FROM supplier) AS artist FROM orders""",
    "mb_release": """
SELECT o_orderkey AS album, CASE WHEN o_orderkey % 10 = 0 THEN '0000-00-00' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS releasedate FROM orders""",
    "seed_list": """
SELECT concat(lower(s_name), '<SEP>', lower(CASE WHEN l_orderkey % 50 = 0 THEN p_name ELSE concat(p_name, ' (live)') END)) AS line FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey""",
    "enrich_input": """
SELECT c.song_id, c.title, coalesce(b.name, '') AS release, c.artist AS artist_name, c.artist_id, a.gid AS artist_mbid
FROM catalog c LEFT JOIN artists a ON a.artist_id = c.artist_id LEFT JOIN mb_album b ON b.id = c.album_id""",
    "mb_artist": """SELECT artist_id AS id, gid, name FROM artists""",
    "mb_tag": """SELECT DISTINCT substr(sha1(term), 1, 12) AS id, term AS name FROM artist_terms""",
    "mb_artist_tag": """SELECT artist_id AS artist, substr(sha1(term), 1, 12) AS tag, freq AS count FROM artist_terms""",
    "vectors": """
SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, label FROM embeddings""",
}

_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _deps(sql: str, known: dict[str, str]) -> list[str]:
    words = set(_WORD.findall(sql))
    return [v for v in known if v in words]


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with ``WITH`` CTEs for every adapter view it references
    (transitively), in dependency order.  ``extra`` adds query-local CTEs that
    may themselves use views; they are emitted after the views they need."""
    known = dict(VIEWS)
    if extra:
        known.update(extra)
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str):
        if name in seen:
            return
        seen.add(name)
        for d in _deps(known[name], {k: v for k, v in known.items() if k != name}):
            visit(d)
        order.append(name)

    for name in _deps(body, known):
        visit(name)
    if extra:
        for name in extra:
            visit(name)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({known[n].strip()})" for n in order)
    body = body.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH" and body[4:5].isspace():
        return f"WITH {ctes},\n{body[5:].lstrip()}"
    return f"WITH {ctes}\n{body}"
