from covista.sources.buckets import read_buckets, upsert_buckets  # noqa: F401
from covista.sources.models import (  # noqa: F401
    export_factors,
    latest_version,
    load_latest_model,
    save_model,
)
from covista.sources.tables import (  # noqa: F401
    ID_INDEX,
    INTERACTION,
    LINKS_CSV,
    MOVIES_CSV,
    RATINGS_CSV,
    RATED,
    id_frame,
    index_rows,
    interactions,
    latest_interactions,
    one_per_key,
    profile,
    read_csv,
    read_ids,
    read_newest,
    read_table,
    reuse,
    slices,
    update_rows,
    upsert,
    write_ids,
    write_report,
    write_table,
)
