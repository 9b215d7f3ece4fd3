"""Generic operators, parameterised by column names: DataFrame in, DataFrame out."""
