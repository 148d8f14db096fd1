"""Market analytics on Spark: bars, indicators, signals, labels and selection quality as DataFrame plans."""
