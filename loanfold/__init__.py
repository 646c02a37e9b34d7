"""loanfold: batch silver-layer analytics for loan portfolios, written on the Spark DataFrame API."""
