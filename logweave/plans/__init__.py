"""Whole-run plans: the SQL form of the queries, the job runner (one run and
run-all) and the run report."""
