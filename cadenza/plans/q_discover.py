"""Registered queries: ragged arrays, discovery, assembly."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Window
from pyspark.sql import functions as F

from cadenza.operators import discover as D
from cadenza.operators import enrich as EN
from cadenza.operators import ragged as RG
from cadenza.plans.registry import register
from cadenza.session import cut_lineage
from cadenza.sources import catalog as V


class Limits(NamedTuple):
    """How much each discovery step takes."""

    artists: int
    terms: int
    per_term: int
    roots: int
    target: int


#: Small enough to bite on the given tables.
SMALL = Limits(20, 10, 5, 3, 10_000)
# --- fixed values (must equal the reference) --------------------------------
FULL = Limits(100, 200, 100, 100, 1_000_000)
# ---------------------------------------------------------------------------


def returned_quantities(spark, sf):
    """Per album (order): the quantities of its returned line items in line
    order — a ragged array column with empty arrays for albums without any."""
    o = V.read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("ord"))
    li = V.read_table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R") \
        .select(F.col("l_orderkey").alias("ord"), "l_linenumber", "l_quantity")
    arr = li.groupBy("ord").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity"))),
                                            lambda s: s["l_quantity"]).alias("values"))
    return o.join(arr, "ord", "left").select("ord", F.coalesce("values", F.array().cast("array<double>")).alias("values"))


RAGGED_SQL = {"rq_arrays": """
SELECT o.o_orderkey AS ord, coalesce(l.vals, []::DOUBLE[]) AS vals FROM orders o LEFT JOIN (
  SELECT l_orderkey, list(l_quantity ORDER BY l_linenumber, l_quantity) AS vals FROM lineitem WHERE l_returnflag = 'R'
  GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey"""}


@register("ragged_offsets", """
SELECT ord, CAST(len(vals) AS INT) AS n,
       CAST(coalesce(sum(len(vals)) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset
FROM rq_arrays""", RAGGED_SQL)
def q_w4(spark, sf):
    a = returned_quantities(spark, sf).select("ord", F.size("values").alias("n"))
    return RG.ragged_offsets(a, "ord", "n")


@register("ragged_slice", "SELECT ord, vals AS \"values\" FROM rq_arrays", RAGGED_SQL)
def q_w5(spark, sf):
    a = returned_quantities(spark, sf)
    offsets = RG.ragged_offsets(a.select("ord", F.size("values").alias("n")), "ord", "n")
    flat = RG.explode_with_offsets(a, "ord", "values")
    return RG.ragged_slice(flat, offsets)


@register("timbre_mean_std", "SELECT song_id, " + ", ".join(
    f"round(timbre_{m}_{i}, 6) AS timbre_{m}_{i}" for m in ("mean", "std") for i in range(12)) + " FROM timbre_stats")
def q_a10(spark, sf):
    return song_timbre(spark, sf)


def song_timbre(spark, sf, digits=6):
    """The songs' segments as one flat array with offsets, cut into songs again
    by position, and their timbre statistics (``digits``: None leaves them unrounded)."""
    # the order and its prefix sums need the songs' sizes only; the vectors join afterwards
    off = RG.ragged_offsets(V.segment_sizes(spark, sf), "song_id", "n")
    flat = RG.explode_offsets(V.with_segments(spark, sf, off, "float"), "segments")
    return RG.ragged_timbre(flat, off.select("song_id", "offset", "n"), digits=digits, size_col="n")


def _both(name: str, sql, views=None):
    """Register a discovery query with the small limits under its name, and
    with the full ones as ``<name>_full``; ``sql`` and ``views`` take the limits."""

    def deco(fn):
        for lim, full in ((SMALL, name), (FULL, f"{name}_full")):
            register(full, sql(lim), views(lim) if views else None)(lambda spark, sf, lim=lim: fn(spark, sf, lim))
        return fn

    return deco


@_both("top_familiar_artists", lambda lim: f"""
SELECT * FROM artists ORDER BY familiarity DESC, artist_id LIMIT {lim.artists}""")
def q_k1(spark, sf, lim):
    return D.top_familiar_artists(V.artists(spark, sf), lim.artists)


@_both("top_terms", lambda lim: f"""
SELECT term, CAST(sum(freq) AS BIGINT) AS total_freq FROM artist_terms GROUP BY term ORDER BY total_freq DESC, term LIMIT {lim.terms}""")
def q_k2(spark, sf, lim):
    return D.top_terms(V.artist_terms(spark, sf), lim.terms)


# --- fixed values (must equal the reference): the attributes sorted both ways ---
K3_ATTRS = ("tempo", "loudness", "duration", "energy", "danceability", "key", "mode", "song_hotttnesss", "artist_hotttnesss",
            "latitude", "longitude")
# ---------------------------------------------------------------------------


@register("extremes_by_attribute", " UNION ALL ".join(
    f"SELECT song_id, '{a}' AS attribute, '{d}' AS direction, CAST(rank AS INT) AS rank FROM ("
    f"SELECT song_id, row_number() OVER (ORDER BY CAST({a} AS DOUBLE) {d.upper()}, song_id) AS rank FROM catalog JOIN song_attributes USING (song_id) "
    f"WHERE {a} IS NOT NULL) WHERE rank <= 100"
    for a in K3_ATTRS for d in ("asc", "desc")))
def q_k3(spark, sf):
    songs = V.catalog_with_attributes(spark, sf, "song_id", "tempo", "loudness", "danceability", "key", "mode")
    return D.extremes_by_attribute(songs, K3_ATTRS)


@register("most_recent", """
SELECT song_id, CAST(added_at AS DATE) AS added_on FROM catalog ORDER BY added_at DESC, song_id LIMIT 100""")
def q_k4(spark, sf):
    return D.most_recent(V.catalog(spark, sf), 100).select("song_id", F.col("added_at").cast("date").alias("added_on"))


@register("trim_to_target", """
SELECT song_id FROM (SELECT song_id, row_number() OVER (ORDER BY added_at, song_id) AS rn FROM catalog) WHERE rn > 50000""")
def q_k5(spark, sf):
    return D.trim_to_target(V.catalog(spark, sf).select("song_id", "added_at"), 50000, dry_run=True).select("song_id")


@register("random_subset", """
SELECT artist_id, name FROM artists ORDER BY md5(CAST(artist_id AS VARCHAR) || ':42'), artist_id LIMIT 10""")
def q_k6(spark, sf):
    return D.random_subset(V.artists(spark, sf).select("artist_id", "name"), 10, 42, "artist_id")


@register("cap_songs_per_artist", """
SELECT song_id, artist_id, CAST(artist_rank AS INT) AS artist_rank FROM (
  SELECT song_id, artist_id, row_number() OVER (PARTITION BY artist_id ORDER BY song_id) AS artist_rank FROM catalog)
WHERE artist_rank <= 100""")
def q_w3(spark, sf):
    return D.cap_songs_per_artist(V.catalog(spark, sf).select("song_id", "artist_id"), 100)


def disc_sql(lim: Limits) -> dict[str, str]:
    return {
        "terms200": f"""
SELECT term, CAST(row_number() OVER (ORDER BY total_freq DESC, term) AS INT) AS term_rank FROM (
  SELECT term, sum(freq) AS total_freq FROM artist_terms GROUP BY term) QUALIFY term_rank <= {lim.terms}""",
        "by_term": f"""
SELECT artist_id, arg_min(term, (term_rank, fam_rank, term)) AS term, min(term_rank) AS term_rank,
       CAST(arg_min(fam_rank, (term_rank, fam_rank, term)) AS INT) AS fam_rank FROM (
  SELECT t.artist_id, t.term, x.term_rank,
         row_number() OVER (PARTITION BY t.term ORDER BY a.familiarity DESC, t.artist_id) AS fam_rank
  FROM artist_terms t JOIN terms200 x ON x.term = t.term JOIN artists a ON a.artist_id = t.artist_id)
WHERE fam_rank <= {lim.per_term} GROUP BY artist_id""",
        "nb10": """
SELECT src, dst FROM (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY weight DESC, dst) AS rn
                      FROM artist_similarity) WHERE rn <= 10""",
        "roots": f"SELECT artist_id FROM artists ORDER BY familiarity DESC, artist_id LIMIT {lim.roots}",
    }


BFS_SQL = """
WITH RECURSIVE bfs(artist_id, depth) AS (
  SELECT artist_id, 0 FROM roots
  UNION
  SELECT n.dst, b.depth + 1 FROM bfs b JOIN nb10 n ON n.src = b.artist_id WHERE b.depth < (SELECT count(*) FROM artists))
SELECT artist_id, CAST(min(depth) AS INT) AS depth FROM bfs GROUP BY artist_id"""


def _term_artists(spark, sf, lim):
    # rank over the few rows left after the top-terms limit (bounded, one task is fine)
    freq = cut_lineage(V.artist_terms(spark, sf))   # read by the ranking and by the pick
    terms = D.top_terms(freq, lim.terms).withColumn(
        "term_rank", F.row_number().over(Window.orderBy(F.desc("total_freq"), "term")))
    return D.artists_by_term(freq, V.artists(spark, sf), terms, lim.per_term)


@_both("artists_by_term", lambda lim: "SELECT * FROM by_term", disc_sql)
def q_j11(spark, sf, lim):
    return _term_artists(spark, sf, lim)


def _bfs(spark, sf, lim):
    r = D.top_familiar_artists(V.artists(spark, sf), lim.roots).select("artist_id")
    return D.expand_similar_artists(r, V.artist_similarity(spark, sf), 10, parts=V.similarity_parts(spark, sf))


@_both("expand_similar_artists", lambda lim: BFS_SQL, disc_sql)
def q_j12(spark, sf, lim):
    return _bfs(spark, sf, lim)


@register("union_features", """
SELECT song_id, tempo, danceability FROM songs WHERE mode = 0 UNION ALL
SELECT song_id, tempo, NULL FROM songs WHERE mode = 1""")
def q_u1(spark, sf):
    s = V.songs(spark, sf)
    a = s.where(F.col("mode") == 0).select("song_id", "tempo", "danceability")
    b = s.where(F.col("mode") == 1).select("song_id", "tempo")
    return D.union_features([a, b])


@register("dedupe_tracks", """
SELECT song_id, album_id, CAST(added_at AS DATE) AS added_on FROM catalog""")
def q_u2(spark, sf):
    return V.dedupe_by(V.songs(spark, sf), "song_id").select(
        "song_id", "album_id", F.col("added_at").cast("date").alias("added_on"))


def bfs_sql(lim: Limits) -> dict[str, str]:
    return {**disc_sql(lim), "bfs_artists": BFS_SQL.replace("WITH RECURSIVE", "SELECT * FROM (WITH RECURSIVE") + ")"}


@_both("visited_distinct", lambda lim: f"""
SELECT artist_id FROM (SELECT artist_id FROM bfs_artists UNION SELECT artist_id FROM by_term
                       UNION SELECT artist_id FROM (SELECT * FROM artists ORDER BY familiarity DESC, artist_id LIMIT {lim.artists}))""", bfs_sql)
def q_u3(spark, sf, lim):
    a = V.artists(spark, sf)
    return D.visited_distinct([_bfs(spark, sf, lim).select("artist_id"), _term_artists(spark, sf, lim), D.top_familiar_artists(a, lim.artists)])


def assemble_sql(lim: Limits) -> dict[str, str]:
    return {
        **bfs_sql(lim),
        "sd": """
SELECT DISTINCT lower(trim(split_part(line, '<SEP>', 1))) AS a, lower(trim(split_part(line, '<SEP>', 2))) AS t FROM seed_list""",
        "first_match": """
SELECT arg_min(c.song_id, c.song_id) AS song_id, arg_min(c.artist_id, c.song_id) AS artist_id
FROM (SELECT song_id, artist_id, lower(trim(artist)) AS a, lower(trim(title)) AS t FROM catalog) c
JOIN sd ON sd.a = c.a AND sd.t = c.t GROUP BY c.a, c.t""",
        "capped": """
SELECT song_id, artist_id, row_number() OVER (PARTITION BY artist_id ORDER BY song_id) AS artist_rank FROM catalog""",
        "steps": f"""
SELECT song_id, 1 AS step FROM capped WHERE artist_rank <= 100
  AND artist_id IN (SELECT artist_id FROM artists ORDER BY familiarity DESC, artist_id LIMIT {lim.artists})
UNION ALL SELECT song_id, 2 FROM capped WHERE artist_rank <= 100 AND artist_id IN (SELECT artist_id FROM by_term)
UNION ALL SELECT song_id, 3 FROM (
  SELECT song_id FROM first_match UNION ALL
  SELECT song_id FROM capped WHERE artist_rank <= 100 AND artist_id IN (SELECT artist_id FROM first_match))
UNION ALL SELECT song_id, 4 FROM (""" + " UNION ALL ".join(
        f"SELECT song_id FROM (SELECT song_id, row_number() OVER (ORDER BY CAST({a} AS DOUBLE) {d}, song_id) AS r "
        f"FROM catalog JOIN song_attributes USING (song_id) WHERE {a} IS NOT NULL) WHERE r <= 100" for a in K3_ATTRS for d in ("ASC", "DESC")) + """)
UNION ALL SELECT song_id, 5 FROM capped WHERE artist_rank <= 50 AND artist_id IN (SELECT artist_id FROM bfs_artists)""",
    }


@_both("assemble_catalog", lambda lim: f"""
SELECT song_id, step FROM (
  SELECT song_id, step, row_number() OVER (ORDER BY step, song_id) AS rn FROM (
    SELECT song_id, min(step) AS step FROM steps GROUP BY song_id)) WHERE rn <= {lim.target}""", assemble_sql)
def q_u4(spark, sf, lim):
    cat = V.catalog_with_attributes(spark, sf, "song_id", "artist_id", "artist", "title", "tempo", "loudness", "danceability", "key", "mode")
    cat = cut_lineage(cat)   # read by four steps: built and deduplicated once
    matched = cut_lineage(EN.first_matches(EN.parse_seed_list(V.seed_list(spark, sf)), cat))
    by_artist = D.songs_by_artist_steps(cat, [
        (1, D.top_familiar_artists(V.artists(spark, sf), lim.artists), 100), (2, _term_artists(spark, sf, lim), 100),
        (3, matched, 100), (5, _bfs(spark, sf, lim), 50)])
    extremes = D.extremes_by_attribute(cat, K3_ATTRS)
    tagged = by_artist.unionByName(matched.select("song_id", F.lit(3).alias("step"))).unionByName(extremes.select("song_id", F.lit(4).alias("step")))
    return D.assemble_tagged(tagged, lim.target)
