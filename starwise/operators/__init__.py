"""DataFrame in, DataFrame out: statistics, LSH, similarity, prediction, model, evaluation."""
