from snapfold.ml.evaluation import metric_report
from snapfold.ml.features import export_features, feature_stages, fit_features
from snapfold.ml.mlp import MLPRegressionModel, MLPRegressor, deep_mlp, fit_grid, shallow_mlp
from snapfold.ml.moments import correlated_columns, correlations
from snapfold.ml.ridge import ridge_report
from snapfold.ml.sparse import SparseFeaturesModel, vector_entries
from snapfold.ml.sparse_mlp import SparseMLPModel, SparseMLPRegressor
from snapfold.ml.tuning import cross_validate, param_grid

__all__ = [
    "MLPRegressionModel",
    "MLPRegressor",
    "SparseFeaturesModel",
    "SparseMLPModel",
    "SparseMLPRegressor",
    "correlated_columns",
    "correlations",
    "cross_validate",
    "deep_mlp",
    "export_features",
    "feature_stages",
    "fit_features",
    "fit_grid",
    "metric_report",
    "param_grid",
    "ridge_report",
    "shallow_mlp",
    "vector_entries",
]
