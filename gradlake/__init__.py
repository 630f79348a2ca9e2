"""Linear-model training and experiment analytics as Spark jobs."""

from gradlake.plans.fit import FitResult, fit, fit_and_score
from gradlake.session import local_session

__all__ = ["FitResult", "fit", "fit_and_score", "local_session"]
