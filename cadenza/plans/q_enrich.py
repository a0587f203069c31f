"""Registered queries: enrichment (music DB, tags, seed list) and payload shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions import payload as PL
from cadenza.operators import enrich as EN
from cadenza.plans.registry import register
from cadenza.session import cut_lineage
from cadenza.sources import catalog as V


def _mb(spark, sf):
    return V.mb_artist(spark, sf), V.mb_track(spark, sf, "name", "artist", "album"), V.mb_album(spark, sf), V.mb_release(spark, sf)


MB_SQL = {
    "dated": """
SELECT b.id AS album_id, b.artist AS album_artist, lower(b.name) AS album_lname, r.releasedate
FROM mb_album b JOIN mb_release r ON r.album = b.id WHERE r.releasedate <> '0000-00-00'""",
    "t3": """
SELECT a.gid, lower(t.name) AS lname, min(d.releasedate) AS date_mbid_title
FROM mb_track t JOIN mb_artist a ON a.id = t.artist JOIN dated d ON d.album_id = t.album GROUP BY 1, 2""",
    "t4": """
SELECT a.gid, d.album_lname, min(d.releasedate) AS date_mbid_release
FROM dated d JOIN mb_artist a ON a.id = d.album_artist GROUP BY 1, 2""",
    "t5a": """
SELECT lower(a.name) AS artist_lname, lower(t.name) AS lname, min(d.releasedate) AS date_name_title
FROM mb_track t JOIN mb_artist a ON a.id = t.artist JOIN dated d ON d.album_id = t.album GROUP BY 1, 2""",
    "t5b": """
SELECT lower(a.name) AS artist_lname, d.album_lname, min(d.releasedate) AS date_name_release
FROM dated d JOIN mb_artist a ON a.id = d.album_artist GROUP BY 1, 2""",
    "years": """
SELECT s.song_id, coalesce(TRY_CAST(split_part(CASE WHEN k.gid IS NOT NULL THEN coalesce(t3.date_mbid_title, t4.date_mbid_release)
                                               ELSE coalesce(t5a.date_name_title, t5b.date_name_release) END, '-', 1) AS INT), 0) AS year
FROM enrich_input s
LEFT JOIN (SELECT DISTINCT gid FROM mb_artist WHERE gid <> '') k ON k.gid = s.artist_mbid
LEFT JOIN t3 ON t3.gid = s.artist_mbid AND t3.lname = lower(s.title)
LEFT JOIN t4 ON t4.gid = s.artist_mbid AND t4.album_lname = lower(s.release)
LEFT JOIN t5a ON t5a.artist_lname = lower(s.artist_name) AND t5a.lname = lower(s.title)
LEFT JOIN t5b ON t5b.artist_lname = lower(s.artist_name) AND t5b.album_lname = lower(s.release)""",
    "tags": """
SELECT a.id AS artist_id, coalesce(l.tags, []::VARCHAR[]) AS tags, coalesce(l.tag_counts, []::BIGINT[]) AS tag_counts
FROM mb_artist a LEFT JOIN (
  SELECT gid, list(tag_name ORDER BY rn) AS tags, list(count ORDER BY rn) AS tag_counts FROM (
    SELECT a.gid, g.name AS tag_name, x.count,
           row_number() OVER (PARTITION BY a.gid ORDER BY x.count DESC, g.name) AS rn
    FROM mb_artist_tag x JOIN mb_tag g ON g.id = x.tag JOIN mb_artist a ON a.id = x.artist WHERE a.gid <> '')
  WHERE rn <= 20 GROUP BY gid) l ON l.gid = a.gid""",
}


@register("mb_year_by_mbid_title", "SELECT * FROM t3", MB_SQL)
def q_j3(spark, sf):
    a, t, b, r = _mb(spark, sf)
    return EN.year_by_mbid_title(a, t, b, r)


@register("mb_year_by_mbid_release", "SELECT * FROM t4", MB_SQL)
def q_j4(spark, sf):
    a, _, b, r = _mb(spark, sf)
    return EN.year_by_mbid_release(a, b, r)


@register("mb_year_by_name", """
SELECT artist_lname, lname AS match_name, date_name_title AS releasedate, 'title' AS matched_on FROM t5a UNION ALL
SELECT artist_lname, album_lname, date_name_release, 'release' FROM t5b""", MB_SQL)
def q_j5(spark, sf):
    a, t, b, r = _mb(spark, sf)
    by_t, by_r = EN.year_by_name(a, t, b, r)
    return by_t.select("artist_lname", F.col("lname").alias("match_name"), F.col("date_name_title").alias("releasedate"),
                       F.lit("title").alias("matched_on")).unionByName(
        by_r.select("artist_lname", F.col("album_lname").alias("match_name"),
                    F.col("date_name_release").alias("releasedate"), F.lit("release").alias("matched_on")))


@register("find_release_year", "SELECT * FROM years", MB_SQL, headline=True)
def q_j6(spark, sf):
    a, t, b, r = _mb(spark, sf)
    return EN.find_release_year(V.enrich_input(spark, sf), a, t, b, r)


@register("release_year", """
SELECT album, TRY_CAST(split_part(releasedate, '-', 1) AS INT) AS year FROM mb_release WHERE releasedate <> '0000-00-00'""")
def q_h25(spark, sf):
    r = V.mb_release(spark, sf).where(F.col("releasedate") != EN.NO_DATE)
    return r.select("album", PL.release_year(F.col("releasedate")).alias("year"))


@register("normalize_match_text", "SELECT id, lower(name) AS lname FROM mb_track")
def q_h26(spark, sf):
    return V.mb_track(spark, sf).select("id", PL.normalize_match_text(F.col("name")).alias("lname"))


def _tags(spark, sf):
    return EN.artist_tags(V.mb_artist(spark, sf), V.mb_artist_tag(spark, sf), V.mb_tag(spark, sf))


@register("artist_tags", "SELECT * FROM tags", MB_SQL)
def q_j7(spark, sf):
    return _tags(spark, sf)


SEED_SQL = {
    "sd": """
SELECT DISTINCT lower(trim(split_part(line, '<SEP>', 1))) AS a, lower(trim(split_part(line, '<SEP>', 2))) AS t FROM seed_list""",
    "first_match": """
SELECT arg_min(c.song_id, c.song_id) AS song_id, arg_min(c.artist_id, c.song_id) AS artist_id
FROM (SELECT song_id, artist_id, lower(trim(artist)) AS a, lower(trim(title)) AS t FROM catalog) c
JOIN sd ON sd.a = c.a AND sd.t = c.t GROUP BY c.a, c.t""",
}


@register("scan_seed_list", """
SELECT trim(split_part(line, '<SEP>', 1)) AS artist, trim(split_part(line, '<SEP>', 2)) AS title FROM seed_list""")
def q_s4(spark, sf):
    return EN.parse_seed_list(V.seed_list(spark, sf))


@register("resolve_seed_list", """
SELECT song_id, min(step) AS step FROM (
  SELECT song_id, 1 AS step FROM first_match UNION ALL
  SELECT song_id, 2 FROM catalog WHERE artist_id IN (SELECT artist_id FROM first_match)) GROUP BY song_id""", SEED_SQL)
def q_j8(spark, sf):
    return EN.resolve_seed_list(EN.parse_seed_list(V.seed_list(spark, sf)), V.catalog(spark, sf))


@register("exclude_seed", """
SELECT song_id, cluster_id FROM clustered_catalog WHERE song_id NOT IN (SELECT song_id FROM first_match)""", SEED_SQL)
def q_p13(spark, sf):
    from cadenza.operators.clean import exclude_seed
    seeds = EN.resolve_seed_list(EN.parse_seed_list(V.seed_list(spark, sf)), V.catalog(spark, sf)) \
        .where(F.col("step") == 1)
    return exclude_seed(V.clustered_catalog(spark, sf).select("song_id", "cluster_id"), seeds)


@register("enrichment_coverage", """
SELECT count(*) AS n_songs, CAST(count_if(coalesce(s.artist_mbid, '') <> '') AS BIGINT) AS with_mbid,
       CAST(count_if(y.year > 0) AS BIGINT) AS with_year, CAST(count_if(coalesce(len(t.tags), 0) > 0) AS BIGINT) AS with_tags
FROM enrich_input s LEFT JOIN years y ON y.song_id = s.song_id LEFT JOIN tags t ON t.artist_id = s.artist_id""", MB_SQL)
def q_a13(spark, sf):
    a, t, b, r = _mb(spark, sf)
    songs = cut_lineage(V.enrich_input(spark, sf))   # read by the cascade and by the count
    years = EN.find_release_year(songs, a, t, b, r)
    return EN.enrichment_coverage(songs, years, _tags(spark, sf))


# --- payload shaping -----------------------------------------------------------------

NOTES_SQL = {
    "notes": """
SELECT * FROM (VALUES ('C', 0), ('C#', 1), ('Db', 1), ('D', 2), ('D#', 3), ('Eb', 3), ('E', 4), ('F', 5), ('F#', 6),
  ('Gb', 6), ('G', 7), ('G#', 8), ('Ab', 8), ('A', 9), ('A#', 10), ('Bb', 10), ('B', 11)) t(note, k)""",
    "keyed": """
SELECT event_id, payload, key_of, s, lower(s) LIKE '%m' AS minor,
       CASE WHEN lower(s) LIKE '%m' THEN trim(substr(s, 1, length(s) - 1)) ELSE s END AS root
FROM (SELECT event_id, payload, coalesce(json_extract_string(payload, '$.key_of'), 'C') AS key_of,
             replace(replace(trim(coalesce(json_extract_string(payload, '$.key_of'), 'C')), '♯', '#'), '♭', 'b') AS s
      FROM api_payload)""",
    "parsed_keys": """
SELECT y.event_id, y.payload,
       CASE WHEN y.key_of = '' THEN NULL ELSE n.k END AS key,
       CASE WHEN y.key_of = '' THEN NULL WHEN y.minor THEN 0 ELSE 1 END AS mode
FROM keyed y LEFT JOIN notes n ON n.note = y.root""",
    "normalized": """
SELECT event_id, coalesce(json_extract_string(payload, '$.title'), '') AS track_name,
       coalesce(json_extract_string(payload, '$.artist.name'), json_extract_string(payload, '$.artist[0].name'), '') AS artist_name,
       TRY_CAST(coalesce(json_extract_string(payload, '$.tempo'), '0.0') AS DOUBLE) AS tempo,
       round((1 - TRY_CAST(coalesce(json_extract_string(payload, '$.acousticness'), '50') AS DOUBLE) / 100) * 60 - 60, 2) AS loudness,
       coalesce(key, 0) AS key, coalesce(mode, 1) AS mode,
       coalesce(TRY_CAST(trim(split_part(coalesce(json_extract_string(payload, '$.time_signature'), '4/4'), '/', 1)) AS INT), 4) AS time_signature
FROM parsed_keys""",
}


@register("parse_musical_key", "SELECT event_id, key, mode FROM parsed_keys", NOTES_SQL)
def q_h18(spark, sf):
    p = V.api_payload(spark, sf)
    km = PL.parse_musical_key(F.coalesce(F.get_json_object("payload", "$.key_of"), F.lit("C")))
    return p.select("event_id", km.getField("key").alias("key"), km.getField("mode").alias("mode"))


@register("parse_time_signature", """
SELECT event_id, TRY_CAST(trim(split_part(json_extract_string(payload, '$.time_signature'), '/', 1)) AS INT) AS time_signature
FROM api_payload""")
def q_h19(spark, sf):
    p = V.api_payload(spark, sf)
    return p.select("event_id", PL.parse_time_signature(F.get_json_object("payload", "$.time_signature")).alias("time_signature"))


@register("acousticness_to_loudness", """
SELECT event_id, round((1 - TRY_CAST(json_extract_string(payload, '$.acousticness') AS DOUBLE) / 100) * 60 - 60, 2) AS loudness
FROM api_payload""")
def q_h20(spark, sf):
    p = V.api_payload(spark, sf)
    ac = F.get_json_object("payload", "$.acousticness").try_cast("double")
    return p.select("event_id", PL.acousticness_to_loudness(ac).alias("loudness"))


@register("extract_artist_name", """
SELECT event_id, coalesce(json_extract_string(payload, '$.artist.name'), json_extract_string(payload, '$.artist[0].name'), '') AS artist_name
FROM api_payload""")
def q_h21(spark, sf):
    p = V.api_payload(spark, sf)
    return p.select("event_id", PL.extract_artist_name(F.col("payload")).alias("artist_name"))


@register("normalize_api_features", "SELECT * FROM normalized", NOTES_SQL)
def q_h22(spark, sf):
    return PL.normalize_api_features(V.api_payload(spark, sf))


@register("recommendation_id", """
SELECT event_id, upper(substr(sha1(track_name || '-' || artist_name), 1, 16)) AS recommendation_id FROM normalized""",
          NOTES_SQL)
def q_h23(spark, sf):
    n = PL.normalize_api_features(V.api_payload(spark, sf))
    return n.select("event_id", PL.recommendation_id(F.col("track_name"), F.col("artist_name")).alias("recommendation_id"))


@register("publish_requests", """
SELECT upper(substr(sha1(track_name || '-' || artist_name), 1, 16)) AS key,
       CAST(json_object('track_name', track_name, 'artist_name', artist_name, 'tempo', tempo, 'loudness', loudness,
                   'key', key, 'mode', mode, 'time_signature', time_signature) AS VARCHAR) AS value
FROM normalized""", NOTES_SQL)
def q_t4(spark, sf):
    from cadenza.operators.clean import validate_required
    good, _ = validate_required(PL.normalize_api_features(V.api_payload(spark, sf)))
    return PL.to_request_message(good)


@register("parse_foreign_id", """
WITH f AS (SELECT artist_id, concat(CASE artist_id % 3 WHEN 0 THEN 'musicbrainz' WHEN 1 THEN '7digital' ELSE 'playme' END,
                                  ':artist:', CASE WHEN artist_id % 3 = 0 THEN gid ELSE CAST(artist_id AS VARCHAR) END) AS fid
           FROM artists)
SELECT artist_id, fid,
       CASE WHEN fid <> '' AND split_part(fid, ':', 1) = 'musicbrainz' THEN split_part(fid, ':', 3) ELSE '' END AS mbid,
       coalesce(CASE WHEN fid <> '' AND split_part(fid, ':', 1) = '7digital' THEN TRY_CAST(split_part(fid, ':', 3) AS INT) END, -1) AS digital_id
FROM f""")
def q_h24(spark, sf):
    a = V.artists(spark, sf)
    space = F.when(F.col("artist_id") % 3 == 0, "musicbrainz").when(F.col("artist_id") % 3 == 1, "7digital").otherwise("playme")
    ident = F.when(F.col("artist_id") % 3 == 0, F.col("gid")).otherwise(F.col("artist_id").cast("string"))
    f = a.select("artist_id", F.concat(space, F.lit(":artist:"), ident).alias("fid"))
    return f.select("artist_id", "fid", PL.parse_foreign_id(F.col("fid"), "musicbrainz").alias("mbid"),
                    PL.parse_foreign_id(F.col("fid"), "7digital", as_int=True).alias("digital_id"))


@register("spotify_shape_features", "SELECT track_name, artist_name, tempo, loudness, tempo * 1000 / 1000 AS duration, "
          "key, mode, time_signature, " + ", ".join([f"CAST(0.0 AS DOUBLE) AS timbre_mean_{i}" for i in range(12)] +
                                                   [f"CAST(1.0 AS DOUBLE) AS timbre_std_{i}" for i in range(12)]) + " FROM requests")
def q_h27(spark, sf):
    r = V.requests(spark, sf).withColumn("duration_ms", F.col("tempo") * 1000)
    return PL.spotify_shape_features(r)


@register("parse_request_json", """
SELECT recommendation_id, CAST(json_object('artist', artist, 'title', title, 'tempo', tempo, 'key', key) AS VARCHAR) AS value
FROM j2_src""",
          {"j2_src": "SELECT recommendation_id, artist_name AS artist, track_name AS title, tempo, CAST(key AS INT) AS key FROM requests"})
def q_h16(spark, sf):
    r = V.requests(spark, sf).select("recommendation_id", F.col("artist_name").alias("artist"),
                                     F.col("track_name").alias("title"), "tempo", F.col("key").cast("int").alias("key"))
    msg = r.select("recommendation_id", F.to_json(F.struct("artist", "title", "tempo", "key")).alias("value"))
    # round trip: parse the JSON back and re-serialise — must be the identity
    back = msg.select("recommendation_id", PL.parse_reply(F.col("value")).alias("s"))
    return back.select("recommendation_id", F.to_json("s").alias("value"))
