from gramspan.operators.dbscan import DBSCAN, dbscan_sweep, region_query
from gramspan.operators.decomposition import LDA, PCA, TruncatedSVD, reconstruction_comparison
from gramspan.operators.kmeans import KMeans, cluster_sizes, kmeans_sweep
from gramspan.operators.linear import (
    ElasticNet,
    Lasso,
    LinearRegression,
    RegressionModel,
    Ridge,
    ScaledRegression,
    compare_models,
    regularization_path,
)
from gramspan.operators.logistic import LogisticRegression
from gramspan.operators.scaler import StandardScaler
from gramspan.operators.svc import SVC, c_sweep, kernel_sweep, svc_sweep

__all__ = [
    "DBSCAN",
    "ElasticNet",
    "KMeans",
    "LDA",
    "Lasso",
    "LinearRegression",
    "LogisticRegression",
    "PCA",
    "RegressionModel",
    "Ridge",
    "SVC",
    "ScaledRegression",
    "StandardScaler",
    "TruncatedSVD",
    "c_sweep",
    "cluster_sizes",
    "compare_models",
    "dbscan_sweep",
    "kernel_sweep",
    "kmeans_sweep",
    "reconstruction_comparison",
    "region_query",
    "regularization_path",
    "svc_sweep",
]
