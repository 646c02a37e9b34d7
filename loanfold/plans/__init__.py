"""The silver tables. Each module has build(...) -> DataFrame over raw and earlier silver tables."""
