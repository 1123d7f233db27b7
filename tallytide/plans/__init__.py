from tallytide.plans.change import changed_entities, fold_change, fold_change_for, heat_matrix
from tallytide.plans.clustering import ClusterResult, cluster_time_profiles, time_profiles
from tallytide.plans.ingest import ingest, ingest_files, ingest_long
from tallytide.plans.normalize import normalize
from tallytide.plans.projection import PcaResult, sample_pca, sample_vectors, score_samples
from tallytide.plans.trajectories import dynamics

__all__ = [
    "ClusterResult",
    "PcaResult",
    "changed_entities",
    "cluster_time_profiles",
    "dynamics",
    "fold_change",
    "fold_change_for",
    "heat_matrix",
    "ingest",
    "ingest_files",
    "ingest_long",
    "normalize",
    "sample_pca",
    "sample_vectors",
    "score_samples",
    "time_profiles",
]
