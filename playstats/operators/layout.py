"""Two-dimensional layout of the feature matrix (M1).

The reference lays tracks out with a single-machine neighbour-graph embedding.
Here the layout is a distributed PCA (``pyspark.ml.feature.PCA``: one pass builds
the d x d covariance, d = 21, so the driver only ever holds a 21 x 21 matrix) over
L2-normalised rows, which makes Euclidean structure follow the cosine metric the
reference used. Coordinates therefore differ from the reference's; the column
contract (x, y per track) is the same.
"""

from __future__ import annotations

from pyspark.ml.feature import PCA, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.session import cut_lineage


def pca_layout(df: DataFrame, features_col: str = "features", k: int = 2,
               normalise: bool = True) -> DataFrame:
    """Add ``x``, ``y`` (first two principal coordinates) to every row.

    Each component's sign is fixed so that its largest-magnitude loading is
    positive, so reruns and partition counts give the same picture.
    """
    # The fit and the transform both read the input: write it once to the shared
    # checkpoint folder so the feature pipeline is not computed twice.
    vec = cut_lineage(df.withColumn("_v", array_to_vector(F.col(features_col))))
    in_col = "_v"
    if normalise:
        vec = Normalizer(inputCol="_v", outputCol="_vn", p=2.0).transform(vec)
        in_col = "_vn"
    model = PCA(k=k, inputCol=in_col, outputCol="_pc").fit(vec)
    pc = model.pc.toArray()  # d x k loadings, d = number of features
    signs = [1.0 if pc[abs(pc[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    out = model.transform(vec).withColumn("_pa", vector_to_array("_pc"))
    names = ["x", "y"] + [f"pc{j + 1}" for j in range(2, k)]
    out = out.withColumns({names[j]: F.col("_pa")[j] * F.lit(signs[j]) for j in range(k)})
    return out.drop("_v", "_vn", "_pc", "_pa")
