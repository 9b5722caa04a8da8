"""newsflow: news, market and vector-memory processing as Spark DataFrame operators."""
