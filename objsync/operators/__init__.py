"""Plan operators: DataFrame -> DataFrame transformations."""
