"""encore: live-event and music-listening analytics on Spark.

Batch pipelines are plain DataFrame plans (``encore.plans``) built from a few
reusable operators (``encore.operators``): a temporal lookup join, exact
running folds that stay balanced on hot keys, and ranked top-N / bottom-N.
``encore.streaming`` runs the same questions incrementally.
"""

__all__ = ["session", "sources", "operators", "functions", "plans", "streaming"]
