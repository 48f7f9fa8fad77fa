"""Programme titles and the modal genre of each programme.

The genre dimension is cohort-independent: a programme's genre depends only on
the metadata rows titled with it. It is computed once, as one row per
programme, so attaching it to the play counts is a 1:1 join (no fan-out
followed by DISTINCT).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.functions.columns import first_usable_title
from upswing.spec import FALLBACK_TITLE, GENRE_LIST, NOT_A_CLIP, TITLE_COLUMNS

TLEO = "tleo"


def programme_titles(metadata: DataFrame, sentinel: str = NOT_A_CLIP) -> DataFrame:
    """(tleo, genre_list): each metadata row under its first usable title."""
    return metadata.select(
        first_usable_title(TITLE_COLUMNS, FALLBACK_TITLE, sentinel).alias(TLEO),
        F.col(GENRE_LIST).alias("genre_list"),
    )


def titles_matching_any(metadata: DataFrame, played: DataFrame, sentinel: str = NOT_A_CLIP) -> DataFrame:
    """Metadata rows where *any* of the five titles is a played programme, as (tleo, genre_list).

    This is the literal selection (five IN-subqueries joined by OR) as one
    semi-join: each row's distinct titles are laid out under a row number, joined
    to the played titles, and a row that matched by several is kept once. It keeps
    rows that only match through a title other than the chosen one; such rows can
    never join to the plays by the chosen title, which is why the pipeline uses
    ``genre_dimension`` (one semi-join on the chosen title) instead.
    """
    played_titles = played.select(F.col(TLEO).alias("_any")).distinct()
    titles = F.array_distinct(F.array(*TITLE_COLUMNS, FALLBACK_TITLE))
    numbered = metadata.withColumn("_row", F.monotonically_increasing_id())  # before the titles are laid out
    laid_out = numbered.select(
        "_row",
        first_usable_title(TITLE_COLUMNS, FALLBACK_TITLE, sentinel).alias(TLEO),
        F.col(GENRE_LIST).alias("genre_list"),
        F.explode(titles).alias("_any"),
    )
    return laid_out.join(played_titles, "_any", "left_semi").dropDuplicates(["_row"]).select(TLEO, "genre_list")


def modal_genre(titles: DataFrame) -> DataFrame:
    """(tleo, genre): the genre list held by most of a programme's rows.

    NULL genre lists are ignored; a programme with none has no row (so a left
    join gives it a NULL genre). Ties go to the largest genre string, which
    makes the choice deterministic and identical in every cohort.
    """
    counted = (
        titles.where(F.col(TLEO).isNotNull() & F.col("genre_list").isNotNull())
        .groupBy(TLEO, "genre_list")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.groupBy(TLEO).agg(
        F.max_by(F.col("genre_list"), F.struct("n", "genre_list")).alias("genre")
    )


def genre_dimension(metadata: DataFrame, played: DataFrame | None = None) -> DataFrame:
    """Modal genre of each programme, restricted to ``played`` programmes if given.

    The restriction is a left-semi join on the chosen title; its build side is
    the set of distinct played programme names (one row per programme, not per
    play count), which AQE broadcasts when it is small and shuffles otherwise.
    """
    titles = programme_titles(metadata)
    if played is not None:
        titles = titles.join(played.select(TLEO).distinct(), TLEO, "left_semi")
    return modal_genre(titles)


def attach_genre(plays: DataFrame, genres: DataFrame) -> DataFrame:
    """Left join on tleo; a NULL tleo or an unknown programme gets a NULL genre."""
    return plays.join(genres, TLEO, "left")
