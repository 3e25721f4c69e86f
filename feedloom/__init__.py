"""feedloom: product-feed analytics expressed as Spark DataFrame operators."""
