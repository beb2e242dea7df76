"""File-name formats and coded choices."""

# File names and codes that other tools read and write.
STACK_FILE = "particles.%d.mrcs"
STACK_CHUNK_FILE = "particles.%d.%d.mrcs"
LATENT_EPOCH_FILE = "z.%d.pkl"
WEIGHTS_FINAL_FILE = "weights.pkl"
ANALYSIS_DIR = "analyze.%d"
VOLUME_FILE = "vol_%03d.mrc"
KMEANS_VOLUME_FILE = "kmeans%d/vol_%03d.mrc"

EPOCH_CHOICES = {0: "last", 1: "selection"}
LINKAGE_CHOICES = {0: "average", 1: "ward"}
# End of fixed values.
