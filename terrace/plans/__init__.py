"""Table and metric definitions and the jobs that build them."""
