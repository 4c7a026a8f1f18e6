"""Stock-market ownership and trading-flow analytics on Spark DataFrames."""
