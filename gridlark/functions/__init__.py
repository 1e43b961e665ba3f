"""Values of the dialect as Spark columns: kinds, coercion, scalar functions."""
