"""An analytics engine for collections of dated texts, built on Spark DataFrames."""
