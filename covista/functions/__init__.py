from covista.functions.columns import (  # noqa: F401
    bounded_prediction,
    clean_year_title,
    confidence,
    cosine_plus_one,
    distance_to_score,
    dot,
    epoch_millis,
    epoch_seconds,
    euclidean,
    first_nested,
    genre_array,
    half_life_weight,
    has_any_term,
    has_genre,
    implicit_rating,
    in_range,
    lacks_terms,
    list_position,
    logistic_dot,
    move_towards,
    preference,
    scaled_miss,
    settled,
    similarity,
    squared_distance,
    stamp,
    title_terms,
)
