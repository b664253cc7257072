"""Reliable checkpoints and shared scratch space."""

import os
import tempfile
import uuid

CHECKPOINT_DIR = "spark.checkpoint.dir"


def checkpoint_dir(spark):
    """The shared folder the cluster names; a fresh local one only for a local master."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_DIR, None)
    if not named:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith(
                "local-cluster"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="checkpoint-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df):
    """Materialise `df` in reliable storage and forget how it was made."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark, label):
    """A new path under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{label}-{uuid.uuid4().hex}")


def delete(df):
    """Delete the folder of a table written to a scratch path that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        # Files of a partitioned table lie deeper.
        folder = file[:file.rindex("/")]
        while "=" in folder.rsplit("/", 1)[1]:
            folder = folder[:folder.rindex("/")]
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
