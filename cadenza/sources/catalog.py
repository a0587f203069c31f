"""Adapter views: the song-catalog data model over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame; nothing
here triggers an action.  The definitions follow FIXTURES.md §3, so every
view has a DuckDB twin in :mod:`cadenza.plans.oracle`.

Scale notes: the only large input is ``lineitem``.  Joins to ``part`` and
``supplier`` are left to the planner (size-checked broadcast through
``spark.sql.autoBroadcastJoinThreshold`` and AQE, sort-merge beyond it);
column pruning reaches the parquet scan because every view selects the
columns it needs.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.payload import spotify_shape_features
from cadenza.operators.discover import co_occurrence, pair_parts

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S1 — parquet scan of one driver table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# The song catalog's declared schema.
CATALOG_TYPES = {
    "song_id": "string", "title": "string", "artist": "string", "artist_id": "bigint", "album_id": "bigint", "tempo": "double",
    "loudness": "double", "key": "int", "mode": "int", "time_signature": "int", "danceability": "double", "year": "int",
}


def check_schema(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """``df`` as it is, if it has the declared columns with their types (more
    columns may follow); else an error that names the differences."""
    found = dict(df.dtypes)
    wrong = [f"{c}: {found.get(c, 'missing')}, declared {t}" for c, t in declared.items() if found.get(c) != t]
    if wrong:
        raise ValueError("schema differs: " + "; ".join(wrong))
    return df


def short_id(*cols: Column) -> Column:
    """First 16 upper-case hex chars of sha1 over '-'-joined values (H23 form)."""
    return F.upper(F.substring(F.sha1(F.concat_ws("-", *[c.cast("string") for c in cols])), 1, 16))


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat song feature table (one row per line item)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_quantity", "l_discount", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    j = li.join(part, li.l_partkey == part.p_partkey).join(sup, li.l_suppkey == sup.s_suppkey)
    return j.select(*_song_columns())


def _song_id() -> Column:
    return short_id(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")).alias("song_id")


def _song_columns() -> list[Column]:
    return [
        _song_id(),
        F.col("p_name").alias("title"),
        F.col("s_name").alias("artist"),
        F.col("l_suppkey").alias("artist_id"),
        F.col("l_orderkey").alias("album_id"),
        (F.lit(30.0) + F.col("l_extendedprice") % 240).alias("tempo"),
        (F.lit(-60.0) + F.col("l_quantity")).alias("loudness"),
        (F.col("l_partkey") % 12).cast("int").alias("key"),
        (F.col("l_orderkey") % 2).cast("int").alias("mode"),
        F.col("l_linenumber").cast("int").alias("time_signature"),
        (F.col("l_discount") * 10).alias("danceability"),
        F.year("l_shipdate").alias("year"),
        F.col("l_shipdate").alias("added_at"),
    ]


def _attribute_columns() -> list[Column]:
    return [
        (F.lit(60.0) + F.col("l_quantity") * 5).alias("duration"),
        (F.col("l_tax") * 10).alias("energy"),
        (F.col("l_extendedprice") % 100 / 100).alias("song_hotttnesss"),
        ((F.col("s_acctbal") + 1000) / 11000).alias("artist_hotttnesss"),
        (F.col("s_suppkey") % 181 - 90).cast("double").alias("latitude"),
        (F.col("s_suppkey") % 361 - 180).cast("double").alias("longitude"),
    ]


def song_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Further attributes per song id: length, energy, the two popularity
    scores and the artist's place (a repeated id takes the smallest of each)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_extendedprice")
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    j = li.join(sup, li.l_suppkey == sup.s_suppkey).select(_song_id(), *_attribute_columns())
    return j.groupBy("song_id").agg(*[F.min(c).alias(c) for c in j.columns if c != "song_id"])


def segment_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(song_id, base, time_signature, n): the catalog songs with what picks
    their segments and how many those are, a narrow row a song.

    A song id is made of its album, artist and line number, so its copies
    agree on them and only these are grouped."""
    song = songs(spark, sf_dir).groupBy("song_id").agg(*[F.min(c).alias(c) for c in ("album_id", "artist_id", "time_signature")])
    keys = song.select("song_id", (F.col("album_id") * 7 + F.col("artist_id")).alias("base"), "time_signature")
    per = read_table(spark, sf_dir, "embeddings").groupBy("vec_id").agg(F.count(F.lit(1)).alias("many"))
    found = _picked(spark, sf_dir, keys, per, "many")
    return found.select(*keys.columns, sum((F.coalesce(f"many{j}", F.lit(0)) for j in range(1, 3)), F.coalesce("many0", F.lit(0))).cast("int").alias("n"))


def _picked(spark: SparkSession, sf_dir: str, songs_: DataFrame, per: DataFrame, column: str) -> DataFrame:
    """``songs_`` with ``column`` of ``per`` (a row a vec_id) for each of a song's
    0 to 3 vectors, as ``column`` 0, 1 and 2: no song is split up and grouped again."""
    n = read_table(spark, sf_dir, "embeddings").agg(F.count(F.lit(1)).alias("n")).scalar()
    out = songs_
    for j in range(3):
        out = out.withColumn("_key", F.when(F.lit(j) < F.col("time_signature") % 4, (F.col("base") + j) % n)) \
            .join(per.select(F.col("vec_id").alias("_key"), F.col(column).alias(f"{column}{j}")), "_key", "left").drop("_key")
    return out


def with_segments(spark: SparkSession, sf_dir: str, sizes: DataFrame, number: str = "double") -> DataFrame:
    """The rows of ``sizes`` (:func:`segment_sizes`, further columns stay) with
    their ``segments``."""
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", F.slice(F.col("embedding").cast(f"array<{number}>"), 1, 12).alias("timbre"))
    per = emb.groupBy("vec_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("timbre"))), lambda s: s["timbre"]).alias("own"))
    found = _picked(spark, sf_dir, sizes, per, "own")
    none = F.array().cast(f"array<array<{number}>>")
    return found.select(*sizes.columns, F.concat(*[F.coalesce(f"own{j}", none) for j in range(3)]).alias("segments"))


def song_segments(spark: SparkSession, sf_dir: str, number: str = "double") -> DataFrame:
    """(song_id, segments array<array<double>>): 0 to 3 timbre vectors of 12
    numbers per catalog song, of the embeddings; songs without segments have
    an empty array.  ``number``: "float" leaves them as they are stored."""
    return with_segments(spark, sf_dir, segment_sizes(spark, sf_dir), number).select("song_id", "segments")


def vector_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and artist of each vector."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("title"))
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("artist"))
    n_part, n_sup = (d.agg(F.count(F.lit(1)).alias("n")).scalar() for d in (part, sup))
    ids = read_table(spark, sf_dir, "embeddings").select("vec_id", (F.col("vec_id") % n_part).alias("p_partkey"), (F.col("vec_id") % n_sup).alias("s_suppkey"))
    return ids.join(part, "p_partkey").join(sup, "s_suppkey").select("vec_id", "title", "artist")


# Order that decides which copy of a duplicated song id is kept (U2): the
# earliest added, then a full order over the remaining columns.
DEDUPE_ORDER = ("added_at", "album_id", "artist_id", "tempo", "loudness", "danceability", "title")


def dedupe_by(df: DataFrame, key: str, order: tuple[str, ...] = DEDUPE_ORDER) -> DataFrame:
    """U2 — keep one row per ``key``: the first by ``order``.

    Expressed as the least struct of the order's columns and then the others,
    so that a row is shuffled once and not beside a copy of its order; partial
    aggregation reduces a hot key before the shuffle (no window).
    """
    others = [c for c in df.columns if c != key]
    first = [c for c in order if c != key]
    picked = F.min(F.struct(*first, *[c for c in others if c not in first])).alias("_row")
    return df.groupBy(key).agg(picked).select(key, *[f"_row.{c}" for c in others])


def catalog(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Song catalog keyed by song_id (duplicates removed).  ``columns``: only
    these are wanted, so the dedupe carries them and its order and no others."""
    every = songs(spark, sf_dir)
    if not columns:
        return dedupe_by(every, "song_id")
    carried = dict.fromkeys(("song_id", *DEDUPE_ORDER, *columns))
    return dedupe_by(every.select(*carried), "song_id").select(*columns)


def catalog_with_attributes(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """:func:`catalog`'s ``columns`` joined with :func:`song_attributes`, from one
    pass over the line items: both group them by song id.  Attributes are taken
    over all line items of an id, as there, also over those without a part."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_quantity", "l_discount", "l_tax", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    j = li.join(sup, li.l_suppkey == sup.s_suppkey).join(part, li.l_partkey == part.p_partkey, "left")
    carried = [c for c in dict.fromkeys((*DEDUPE_ORDER, *columns)) if c != "song_id"]
    rows = j.select(*_song_columns(), *_attribute_columns(), F.col("p_partkey").isNotNull().alias("_song"))
    attributes = [c for c in rows.columns[-7:-1]]
    per = rows.groupBy("song_id").agg(F.min(F.when(F.col("_song"), F.struct(*carried))).alias("_row"), *[F.min(c).alias(c) for c in attributes])
    return per.where("_row IS NOT NULL").select(*[c if c == "song_id" else f"_row.{c}" for c in columns], *attributes)


CLUSTER_RULE_K = 11


def fixed_cluster(key: Column, time_signature: Column) -> Column:
    """Deterministic stand-in for K-Means ids used by the relational operators."""
    return ((key * 7 + time_signature) % CLUSTER_RULE_K).cast("int")


def clustered_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving table (S10 shape): cleaned songs with a cluster id."""
    s = songs(spark, sf_dir)
    return s.where(F.col("tempo").between(40, 250) & F.col("time_signature").between(1, 5)).select(
        "song_id", "title", "artist", "tempo", "key", "mode",
        fixed_cluster(F.col("key"), F.col("time_signature")).alias("cluster_id"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendation requests (flattened request messages)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return ev.where(F.col("event_type") == "view").select(
        short_id(F.col("event_type"), F.col("event_id")).alias("recommendation_id"),
        "ts",
        F.concat(F.col("event_type"), F.lit("#"), F.col("event_id").cast("string")).alias("track_name"),
        F.concat(F.lit("User#"), F.col("user_id").cast("string")).alias("artist_name"),
        (F.lit(20.0) + F.col("value") % 240).alias("tempo"),
        (F.lit(-60.0) + F.col("value") % 60).alias("loudness"),
        (F.col("user_id") % 12).cast("double").alias("key"),
        (F.col("event_id") % 2).cast("double").alias("mode"),
        (F.col("event_id") % 7).cast("double").alias("time_signature"),
    )


def request_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw (key, value) request messages; 'error' events are malformed JSON,
    'signup' events lack the audio fields, every 97th event has a valid number
    that no int can hold."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    eid, uid = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    full = F.concat(
        F.lit('{"track_name":"t'), eid, F.lit('","artist_name":"u'), uid,
        F.lit('","tempo":'), (F.lit(30) + F.col("event_id") % 240).cast("string"),
        F.lit(',"loudness":'), (F.lit(-1) * (F.col("event_id") % 60)).cast("string"),
        F.lit(',"key":'), F.when(F.col("event_id") % 97 == 0, F.lit("1e12")).otherwise((F.col("user_id") % 12).cast("string")),
        F.lit(',"mode":'), (F.col("event_id") % 2).cast("string"),
        F.lit(',"time_signature":'), (F.col("event_id") % 7).cast("string"), F.lit("}"))
    partial = F.concat(F.lit('{"track_name":"t'), eid, F.lit('","artist_name":"u'), uid, F.lit('"}'))
    value = (F.when(F.col("event_type") == "error", F.lit("{bad"))
             .when(F.col("event_type") == "signup", partial)
             .otherwise(full))
    return ev.select(short_id(F.col("event_type"), F.col("event_id")).alias("key"), value.alias("value"))


def feature_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw (key, value) request messages of the older stream: the shaped song
    features (H27), with malformed and incomplete ones as above."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    eid, uid = F.col("event_id"), F.col("user_id")
    shaped = spotify_shape_features(ev.select(
        short_id(F.col("event_type"), eid).alias("id"), "event_type", F.concat(F.lit("t"), eid).alias("track_name"), F.concat(F.lit("u"), uid).alias("artist_name"),
        (30 + eid % 240).cast("double").alias("tempo"), (-(eid % 60)).cast("double").alias("loudness"), ((60 + eid % 300) * 1000).alias("duration_ms"),
        (uid % 12).cast("double").alias("key"), (eid % 2).cast("double").alias("mode"), (eid % 7).cast("double").alias("time_signature")),
        keep=("id", "event_type"))
    full = F.to_json(F.struct(*[c for c in shaped.columns if c not in ("id", "event_type")]))
    value = (F.when(F.col("event_type") == "error", F.lit("{bad"))
             .when(F.col("event_type") == "signup", F.to_json(F.struct("track_name", "artist_name")))
             .otherwise(full))
    return shaped.select(F.col("id").alias("key"), value.alias("value"))


def api_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loosely typed third-party payloads (artist as object or list)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id")
    eid, uid = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    key_of = (F.when(F.col("user_id") % 6 == 0, "C").when(F.col("user_id") % 6 == 1, "F#m")
              .when(F.col("user_id") % 6 == 2, "B♭").when(F.col("user_id") % 6 == 3, "E♯")
              .when(F.col("user_id") % 6 == 4, "").otherwise("Am"))
    ts = (F.when(F.col("event_id") % 3 == 0, "4/4").when(F.col("event_id") % 3 == 1, "3/4").otherwise("x"))
    artist = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"name":"u'), uid, F.lit('"}'))) \
        .otherwise(F.concat(F.lit('[{"name":"u'), uid, F.lit('"}]')))
    payload = F.concat(
        F.lit('{"title":"t'), eid, F.lit('","tempo":"'), (F.lit(30) + F.col("event_id") % 240).cast("string"),
        F.lit('","key_of":"'), key_of, F.lit('","time_signature":"'), ts,
        F.lit('","acousticness":"'), (F.col("event_id") % 101).cast("string"), F.lit('","artist":'), artist, F.lit("}"))
    return ev.select("event_id", payload.alias("payload"))


def artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return sup.select(
        F.col("s_suppkey").alias("artist_id"), F.col("s_name").alias("name"),
        F.when(F.col("s_suppkey") % 4 == 0, F.lit("")).otherwise(F.sha1(F.col("s_name"))).alias("gid"),
        ((F.col("s_acctbal") + 1000) / 11000).alias("familiarity"))


def artist_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edge table (src, dst, weight): artists sharing an album (order).  An
    album's line items are first summed per artist."""
    parts = similarity_parts(spark, sf_dir)
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").repartition(parts, "l_orderkey")   # the sums and album sizes need no other shuffle
    return co_occurrence(li.groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n")), "l_orderkey", "l_suppkey", parts=parts)


def similarity_parts(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that the pairs of artists are dealt to (line items counted in the file footers)."""
    return pair_parts(spark, read_table(spark, sf_dir, "lineitem").count())


def artist_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return li.join(part, li.l_partkey == part.p_partkey).groupBy(
        F.col("l_suppkey").alias("artist_id"), F.col("p_brand").alias("term")).agg(F.count(F.lit(1)).alias("freq"))


def mb_track(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Tracks (id, name, artist, album).  ``columns``: only these are wanted, so
    the rows are distinct in them; dealt by album, which the tracks join by."""
    s = songs(spark, sf_dir)
    # a third of the albums go by another title, so that they have no match
    other = F.when(F.col("album_id") % 3 == 0, F.concat(F.col("title"), F.lit(" [alt]"))).otherwise(F.col("title"))
    every = s.select(
        F.col("song_id").alias("id"), other.alias("name"),
        F.col("artist_id").alias("artist"), F.col("album_id").alias("album"))
    if not columns:
        return every.distinct()
    wanted = every.select(*columns)
    return (wanted.repartition("album") if "album" in columns else wanted).distinct()


def mb_album(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # number of artists as a scalar subquery (one value, evaluated once)
    n_art = read_table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Album#"), (F.col("o_orderkey") % 97).cast("string")).alias("name"),
        (F.col("o_custkey") % n_art).alias("artist"))


def mb_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return orders.select(
        F.col("o_orderkey").alias("album"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("0000-00-00"))
        .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("releasedate"))


def seed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 input: a text line ``artist<SEP>title`` per line item; the titles of
    49 in 50 orders are of other takes, which the catalog does not have."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    j = li.join(part, li.l_partkey == part.p_partkey) \
        .join(sup, li.l_suppkey == sup.s_suppkey)
    title = F.when(F.col("l_orderkey") % 50 == 0, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" (live)")))
    return j.select(F.concat(F.lower("s_name"), F.lit("<SEP>"), F.lower(title)).alias("line"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog vectors: (vec_id, embedding array<double>, label)."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")


def enrich_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs as the enrichment step sees them: title, release (album name),
    artist name and artist mbid ('' when unknown)."""
    cat = catalog(spark, sf_dir, "song_id", "title", "artist", "artist_id", "album_id")
    art = artists(spark, sf_dir).select("artist_id", F.col("gid").alias("artist_mbid"))
    alb = mb_album(spark, sf_dir).select(F.col("id").alias("album_id"), F.col("name").alias("release"))
    return cat.join(alb, "album_id", "left").join(art, "artist_id", "left").select(   # no mbid goes through the album join
        "song_id", "title", F.coalesce("release", F.lit("")).alias("release"),
        F.col("artist").alias("artist_name"), "artist_id", "artist_mbid")


def mb_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relational artist table (id, gid, name)."""
    return artists(spark, sf_dir).select(F.col("artist_id").alias("id"), "gid", "name")


def mb_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag table (id, name): one id per distinct term."""
    t = artist_terms(spark, sf_dir).select(F.col("term").alias("name")).distinct()
    return t.select(F.sha1("name").substr(1, 12).alias("id"), "name")


def mb_artist_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """artist_tag (artist, tag, count) from the artist terms."""
    t = artist_terms(spark, sf_dir)
    return t.select(F.col("artist_id").alias("artist"), F.sha1("term").substr(1, 12).alias("tag"),
                    F.col("freq").alias("count"))
