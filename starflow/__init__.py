"""Raw event streams to audited, dimensionally modelled tables, on Spark DataFrames."""
