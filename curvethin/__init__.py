"""curvethin: thinning of measured time-series curves on Spark.

Public entry points:

* :class:`curvethin.config.ThinConfig` - parameters;
* :func:`curvethin.operators.thin.thin` / :func:`~curvethin.operators.thin.score`
  - thin one metric of any DataFrame of series;
* :func:`curvethin.plans.pipeline.thin_metrics` / :func:`~curvethin.plans.pipeline.run_batch`
  - the batch over process rows: pending keys, five metrics, tagged output,
  status update.
"""

from .config import ThinConfig

__all__ = ["ThinConfig"]
