"""Chronicle: history, contracts and publishing for repeated full extracts, on PySpark."""
