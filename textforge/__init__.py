"""textforge: Spark operators that turn raw text collections into masked-pair training tables."""
