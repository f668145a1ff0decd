from tidemark.functions.columns import (  # noqa: F401
    OUTCOMES,
    assign_partition,
    batch_delayed,
    batch_folder,
    batch_outcome,
    batch_path,
    commit_point,
    day_text,
    epoch_micros,
    epoch_micros_of,
    hash_partition,
    next_day,
    parse_commit,
    partition_for,
    record_value,
    sign64,
    sign64_signed,
    to_day,
    unsigned_mod,
)
