"""Column expressions. All are built-in Spark functions: no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the recommenders.
DEFAULT_HALF_LIFE = (17 / 3) * 10**8  # seconds
DEFAULT_BOOST = 10
UNKNOWN_YEAR = "1970"
YEAR_PATTERN = r"\(\d{4}\)"


# --- time ---------------------------------------------------------------

def epoch_seconds(time: Column) -> Column:
    """Event time as fractional seconds since 1970 (session time zone for naive times)."""
    return time.cast("timestamp").cast("double")


def epoch_millis(seconds: Column) -> Column:
    return seconds.cast("long") * 1000


def half_life_weight(time: Column, t0: Column | float, half_life: float = DEFAULT_HALF_LIFE,
                     weight: float = 1.0) -> Column:
    """weight * 2^-((t0 - time) / half_life); ``t0`` is in epoch seconds."""
    age = (t0 if isinstance(t0, Column) else F.lit(float(t0))) - epoch_seconds(time)
    return F.lit(float(weight)) * F.pow(F.lit(2.0), -age / F.lit(float(half_life)))


def stamp(time: Column) -> Column:
    return F.date_format(time, "yyyyMMdd_HHmmss")


# --- text and nested values ---------------------------------------------

def genre_array(genres: Column) -> Column:
    return F.split(F.lower(genres), r"\|")


def clean_year_title(title: Column) -> Column:
    """struct(title, release_date): the first "(dddd)" is the year, the title ends one
    character before it; without a year the title stays and the year is 1970."""
    at = F.regexp_instr(title, F.lit(YEAR_PATTERN))
    year = F.substring(F.regexp_substr(title, F.lit(YEAR_PATTERN)), 2, 4)
    cut = F.left(title, F.greatest(at - 2, F.lit(0)))
    return F.when(title.isNotNull(), F.struct(
        F.when(at > 0, cut).otherwise(title).alias("title"),
        F.when(at > 0, year).otherwise(F.lit(UNKNOWN_YEAR)).alias("release_date"),
    ))


def title_terms(title: Column) -> Column:
    return F.filter(F.split(F.lower(title), r"[^\p{L}]+"), lambda t: t != "")


def has_any_term(title: Column, *terms: str) -> Column:
    """Whole-word match of at least one term."""
    return F.arrays_overlap(title_terms(title), F.array(*[F.lit(t.lower()) for t in terms]))


def lacks_terms(title: Column, *terms: str) -> Column:
    return ~has_any_term(title, *terms)


def has_genre(genres: Column, genre: str) -> Column:
    return F.array_contains(genres, genre.lower())


def in_range(value: Column, low=None, high=None) -> Column:
    """Inclusive range; an end given as None is open."""
    test = F.lit(True)
    if low is not None:
        test = test & (value >= F.lit(low))
    if high is not None:
        test = test & (value <= F.lit(high))
    return test


def first_nested(items: Column, field: str) -> Column:
    """``field`` of the first struct in the array; null for an empty array."""
    return F.try_element_at(items, F.lit(1)).getField(field)


def list_position(values: Column, value: Column) -> Column:
    """1-based position in the array, 0 when absent."""
    return F.array_position(values, value)


# --- scores ---------------------------------------------------------------

def settled(score: Column, digits: int = 9) -> Column:
    """Score to a fixed number of digits, so that sums made in another order rank alike.
    Plain double arithmetic: ``round`` goes through decimals, which a sort key cannot afford."""
    return F.rint(score * F.lit(10.0**digits)) / F.lit(10.0**digits)


# --- ratings and co-occurrence ------------------------------------------------------

def implicit_rating() -> Column:
    """Every event counts as one view."""
    return F.lit(1)


def similarity(metric: str, both: Column, left: Column, right: Column) -> Column:
    """Similarity of two items from their common and own viewer counts."""
    if metric == "counts":
        return both.cast("double")
    if metric == "jaccard":
        return both / (left + right - both)
    if metric == "lift":
        return both / (left * right)
    raise ValueError(f"unknown metric {metric!r}; use counts, jaccard or lift")


def preference(rating: Column) -> Column:
    return (rating > 0).cast("int")


def confidence(rating: Column, alpha: float = 1.0) -> Column:
    return F.lit(1.0) + F.lit(float(alpha)) * rating


def scaled_miss(rating: Column, highest: Column) -> Column:
    """(1 - rating / highest)^2, and 1 where nothing was scored."""
    return F.when(highest == 0, F.lit(1.0)).otherwise(F.pow(1 - rating / highest, F.lit(2.0)))


# --- vectors ------------------------------------------------------------

def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def squared_distance(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double"))
                           * (x.cast("double") - y.cast("double"))))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def logistic_dot(a: Column, b: Column) -> Column:
    """1 / (1 + e^-dot); 0 where a vector is missing."""
    return F.coalesce(1 / (1 + F.exp(-dot(a, b))), F.lit(0.0))


def cosine_plus_one(a: Column, b: Column) -> Column:
    """Cosine + 1; 0 where a vector is missing."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    cosine = F.when(norms == 0, F.lit(0.0)).otherwise(dot(a, b) / norms)
    return F.when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(cosine + 1)


def move_towards(x: Column, v: Column, alpha: float) -> Column:
    return F.zip_with(x, v, lambda p, q: p + F.lit(float(alpha)) * (q - p))


def bounded_prediction(distance: Column, radius: float) -> Column:
    return F.when(distance <= F.lit(float(radius)), 1).otherwise(0)


def distance_to_score(distance: Column) -> Column:
    return 1 - distance
