"""DataFrame -> DataFrame operators (joins, aggregations, windows, indexes, model seams)."""
