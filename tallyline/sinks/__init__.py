"""Table writes: full refresh, append, materialise, header/detail, logs."""
