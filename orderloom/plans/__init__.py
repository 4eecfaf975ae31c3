"""Plans: whole-pipeline jobs (all-runs rebuild, one incremental run, the
on-disk store) and the history / inspection queries."""
