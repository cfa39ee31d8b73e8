"""Values that must equal those of the studied programs, or of the Java
behaviour they rely on, for results to match.  Kept together here; the rest
of the library imports them.
"""

# Fixed values.
NUMERIC_PATTERN = r"^[-+]?\d*\.?\d+\z"  # numeric test; anchored at both ends because Java's matches() is
WHITESPACE = r"[ \t\n\x0B\f\r]+"  # Java's \s class: space, tab, newline, vertical tab, form feed, carriage return
MISSING_MARKER = "?"  # marker of a missing reading
MISSING_FILL = 80.0  # value put in its place
RECODE_EQUAL, RECODE_OTHER = 1.0, 2.0  # two-way recode: equal / anything else
REGRESSION_TRAIN_PERCENT = 90  # regression split 0.9 / 0.1
RECOMMENDER_TRAIN_PERCENT = 90  # recommender split 0.9 / 0.1
CLASSIFIER_TRAIN_PERCENT = 70  # tree, forest and Naive Bayes splits 0.7 / 0.3
KMEANS_K, KMEANS_SEED = 4, 1  # k-means clusters and seed
PCA_K = 3  # principal components before the forest
ALS_MAX_ITER, ALS_REG_PARAM = 5, 0.01  # recommender iterations and regularisation
WINDOW_LENGTH, WINDOW_SLIDE = 15, 3  # stream window and slide (time units)
