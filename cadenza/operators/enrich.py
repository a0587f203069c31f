"""Catalog enrichment from a relational music DB.

The reference runs up to three point queries per song.  Here every lookup is
a set-based join: each match table is pre-aggregated to ONE row per match key
(min release date), so the song side joins a unique-keyed table — a hot key
on the song side meets a single build row (AQE splits the skewed partition),
and nothing fans out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.payload import release_year
from cadenza.session import cut_lineage

NO_DATE = "0000-00-00"


def _dated_albums(album: DataFrame, release: DataFrame) -> DataFrame:
    """album ⋈ release with a real date → (album_id, album_artist, lname, date)."""
    rel = release.where(F.col("releasedate") != NO_DATE).select(F.col("album").alias("album_id"), "releasedate")
    alb = album.select(F.col("id").alias("album_id"), F.col("artist").alias("album_artist"),
                       F.lower("name").alias("album_lname"))
    return alb.join(rel, "album_id")


def _per_track(track: DataFrame, album: DataFrame, release: DataFrame) -> DataFrame:
    """Earliest real release date per (artist id, track title)."""
    tr = track.select(F.col("artist").alias("track_artist"), F.lower("name").alias("lname"),
                      F.col("album").alias("album_id"))
    dated = _dated_albums(album, release).select("album_id", "releasedate")
    return tr.join(dated, "album_id").groupBy("track_artist", "lname").agg(F.min("releasedate").alias("releasedate"))


def _per_album(album: DataFrame, release: DataFrame) -> DataFrame:
    """Earliest real release date per (artist id, album name)."""
    return _dated_albums(album, release).groupBy("album_artist", "album_lname").agg(F.min("releasedate").alias("releasedate"))


def _track_dates(artist: DataFrame, track: DataFrame, album: DataFrame, release: DataFrame) -> DataFrame:
    """:func:`_per_track` with the artist's gid and name: the input of J3 and
    J5, whose lookups aggregate it further.  The artist's texts join after the
    dates are reduced, so that no track takes them through a shuffle."""
    art = artist.select(F.col("id").alias("track_artist"), "gid", F.lower("name").alias("artist_lname"))
    return _per_track(track, album, release).join(art, "track_artist").select("gid", "artist_lname", "lname", "releasedate")


def _album_dates(artist: DataFrame, album: DataFrame, release: DataFrame) -> DataFrame:
    """:func:`_per_album` with the artist's gid and name: the input of J4 and J5."""
    art = artist.select(F.col("id").alias("album_artist"), "gid", F.lower("name").alias("artist_lname"))
    return _per_album(album, release).join(art, "album_artist").select("gid", "artist_lname", "album_lname", "releasedate")


def _artist_keys(artist: DataFrame) -> DataFrame:
    """(kind, a, key): a number for each gid (kind 'mbid', not '') and each name
    in lower case (kind 'name') of the artists, stored so that it stays."""
    both = F.explode(F.array(F.struct(F.lit("mbid").alias("kind"), F.col("gid").alias("a")), F.struct(F.lit("name").alias("kind"), F.lower("name").alias("a"))))
    texts = artist.select(both.alias("k")).select("k.*").where(F.col("a").isNotNull() & ((F.col("kind") == "name") | (F.col("a") != ""))).distinct()
    return cut_lineage(texts.withColumn("key", F.monotonically_increasing_id()))


def year_by_mbid_title(artist: DataFrame, track: DataFrame, album: DataFrame, release: DataFrame) -> DataFrame:
    """J3 — (gid, lower(track title)) → earliest release date of its albums."""
    return _track_dates(artist, track, album, release).groupBy("gid", "lname").agg(
        F.min("releasedate").alias("date_mbid_title"))


def year_by_mbid_release(artist: DataFrame, album: DataFrame, release: DataFrame) -> DataFrame:
    """J4 — (gid, lower(album name)) → earliest release date."""
    return _album_dates(artist, album, release).groupBy("gid", "album_lname").agg(
        F.min("releasedate").alias("date_mbid_release"))


def year_by_name(artist: DataFrame, track: DataFrame, album: DataFrame, release: DataFrame) -> tuple[DataFrame, DataFrame]:
    """J5 — (lower(artist name), lower(title)) and (lower(artist name),
    lower(album name)) → earliest release date."""
    by_title = _track_dates(artist, track, album, release).groupBy("artist_lname", "lname").agg(
        F.min("releasedate").alias("date_name_title"))
    by_release = _album_dates(artist, album, release).groupBy("artist_lname", "album_lname").agg(
        F.min("releasedate").alias("date_name_release"))
    return by_title, by_release


def find_release_year(songs: DataFrame, artist: DataFrame, track: DataFrame, album: DataFrame,
                      release: DataFrame) -> DataFrame:
    """J6 — the full cascade for every song.

    ``songs``: song_id, title, release, artist_name, artist_mbid.
    mbid known to the DB: title match (J3), else release match (J4), else 0 —
    no fall back to names.  mbid null / '' / unknown: name matches (J5), else 0.

    A song asks with one key, its mbid if that is known and its artist's name
    otherwise, and in stages: all songs ask for the title, and only those
    without an answer for the release.  Each stage is one join of narrow rows
    with a lookup of one row per key; mbids and names are numbered once, so
    songs and lookups are sent with a number in their place.  What the first
    stage found is stored.
    """
    keys = _artist_keys(artist)
    mbids, names = (keys.where(F.col("kind") == k).select(F.col("a").alias(f"_{k}"), F.col("key").alias(f"{k}_key")) for k in ("mbid", "name"))
    ids = artist.select(F.col("id").alias("_artist"), F.col("gid").alias("_mbid"), F.lower("name").alias("_name")) \
        .join(mbids, "_mbid", "left").join(names, "_name", "left")
    ids = cut_lineage(ids.select("_artist", F.array("mbid_key", "name_key").alias("_keys")))   # read by both lookups

    def lookup(dates: DataFrame, artist_col: str, text: str) -> DataFrame:
        """(key, t) → date for both kinds of artist key."""
        keyed = dates.join(ids, F.col(artist_col) == F.col("_artist")).select(F.explode("_keys").alias("key"), F.col(text).alias("t"), "releasedate")
        return keyed.where("key IS NOT NULL").groupBy("key", "t").agg(F.min("releasedate").alias("date"))

    mbid = F.when(F.col("artist_mbid") != "", F.col("artist_mbid"))
    asked = songs.select("song_id", mbid.alias("_mbid"), F.lower("artist_name").alias("_name"), F.lower("title").alias("t"), F.lower("release").alias("_release"))
    asked = asked.join(mbids, "_mbid", "left").join(names, "_name", "left").select("song_id", F.coalesce("mbid_key", "name_key").alias("key"), "t", "_release")
    first = cut_lineage(asked.join(lookup(_per_track(track, album, release), "track_artist", "lname"), ["key", "t"], "left").select("song_id", "key", "_release", "date"))
    rest = first.where("date IS NULL").select("song_id", "key", F.col("_release").alias("t"))
    second = rest.join(lookup(_per_album(album, release), "album_artist", "album_lname"), ["key", "t"], "left")
    found = first.where("date IS NOT NULL").select("song_id", "date").unionByName(second.select("song_id", "date"))
    return found.select("song_id", F.coalesce(release_year(F.col("date")), F.lit(0)).alias("year"))


def artist_tags(artist: DataFrame, artist_tag: DataFrame, tag: DataFrame, max_tags: int = 20) -> DataFrame:
    """J7 — per artist gid: up to ``max_tags`` (tag, count), count desc, ties by
    tag name; artists without gid get empty lists.

    ``row_number() ≤ k`` is planned with a group limit (partial top-k before
    the shuffle), so only k rows per artist and partition move; the final
    collect holds ≤ k rows per group."""
    t = artist_tag.join(tag.select(F.col("id").alias("tag"), F.col("name").alias("tag_name")), "tag") \
        .join(artist.select(F.col("id").alias("artist"), "gid"), "artist").where(F.col("gid") != "")
    w = Window.partitionBy("gid").orderBy(F.desc("count"), "tag_name")
    top = t.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= max_tags)
    lists = top.groupBy("gid").agg(F.array_sort(F.collect_list(F.struct("rn", "tag_name", "count"))).alias("l"))
    out = artist.select(F.col("id").alias("artist_id"), "gid").join(lists, "gid", "left")
    empty = F.array().cast("array<struct<rn:int,tag_name:string,count:bigint>>")
    l = F.coalesce("l", empty)
    return out.select("artist_id", F.transform(l, lambda x: x["tag_name"]).alias("tags"),
                      F.transform(l, lambda x: x["count"]).alias("tag_counts"))


def parse_seed_list(lines: DataFrame, col: str = "line") -> DataFrame:
    """S4 — 'artist<SEP>title' text → trimmed (artist, title)."""
    title = F.when(F.locate("<SEP>", F.col(col)) > 0, F.substring_index(F.substring_index(col, "<SEP>", 2), "<SEP>", -1))
    return lines.select(F.trim(F.substring_index(col, "<SEP>", 1)).alias("artist"), F.trim(title).alias("title"))


def first_matches(seeds: DataFrame, catalog: DataFrame) -> DataFrame:
    """(song_id, artist_id): for each (artist, title) seed the first exact
    match (smallest song_id, case-insensitive)."""
    key = [F.lower(F.trim("artist")).alias("a"), F.lower(F.trim("title")).alias("t")]
    want = seeds.select(*key).distinct()
    cat = catalog.select("song_id", "artist_id", *key)
    return cat.join(want, ["a", "t"], "left_semi").groupBy("a", "t").agg(
        F.min(F.struct("song_id", "artist_id")).alias("m")).select("m.song_id", "m.artist_id")


def resolve_seed_list(seeds: DataFrame, catalog: DataFrame, per_artist: int | None = None) -> DataFrame:
    """J8 — the first match of each seed, then every song of the matched
    artists (at most ``per_artist`` of each, by song_id).
    Output: distinct (song_id, step) with step 1 = matched seed, 2 = artist."""
    first = cut_lineage(first_matches(seeds, catalog))   # read by both steps
    matched_artists = first.select("artist_id").distinct()
    by_artist = catalog.select("song_id", "artist_id").join(matched_artists, "artist_id", "left_semi")
    if per_artist is not None:
        w = Window.partitionBy("artist_id").orderBy("song_id")
        by_artist = by_artist.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= per_artist).drop("_r")
    both = first.select("song_id", F.lit(1).alias("step")).unionByName(by_artist.select("song_id", F.lit(2).alias("step")))
    return both.groupBy("song_id").agg(F.min("step").alias("step"))


def enrichment_coverage(songs: DataFrame, years: DataFrame, tags: DataFrame) -> DataFrame:
    """A13 — how many songs got an mbid, a year and tags (one aggregate); what
    is counted joins as yes or no."""
    s = songs.select("song_id", "artist_id", (F.coalesce(F.col("artist_mbid"), F.lit("")) != "").alias("mbid")) \
        .join(years.select("song_id", (F.col("year") > 0).alias("dated")), "song_id", "left") \
        .join(tags.select("artist_id", (F.coalesce(F.size("tags"), F.lit(0)) > 0).alias("tagged")), "artist_id", "left")
    return s.agg(F.count(F.lit(1)).alias("n_songs"),
                 F.count_if("mbid").alias("with_mbid"),
                 F.count_if("dated").alias("with_year"),
                 F.count_if("tagged").alias("with_tags"))
