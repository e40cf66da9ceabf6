"""Water-level image analytics and price-series reporting as Spark jobs."""
