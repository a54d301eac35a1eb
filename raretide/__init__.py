"""raretide: Spark-native feature engineering and rare-event scoring.

Sub-packages: ``sources`` (entity tables, scans, sinks, stages), ``functions``
(row-level column expressions), ``operators`` (DataFrame-in/DataFrame-out
steps: profiling, folds, encoding, imputation, metrics, blending, ranking,
resampling, learners) and ``plans`` (the end-to-end scoring plan and the query
catalogue).
"""

__version__ = "0.1.0"
