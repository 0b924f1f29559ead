"""Several tables published as one set: written aside under a new version, then named by one manifest.

Readers follow the newest manifest, so a rebuild that dies between two tables leaves the old set readable as it was.
"""

import json
import uuid

VERSIONS, MANIFESTS = "_versions", "_manifests"


def _files(spark, path):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark, root):
    """Numbers of the published versions, ascending."""
    folder, files = _files(spark, f"{root}/{MANIFESTS}")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:1].isdigit())


def published(spark, root):
    """Paths by table name of the newest complete set; None if there is none."""
    versions = _versions(spark, root)
    if not versions:
        return None
    lines = spark.read.text(f"{root}/{MANIFESTS}/{versions[-1]:09d}.json").collect()
    return {name: f"{root}/{path}" for name, path in json.loads("".join(r["value"] for r in lines)).items()}


def publish(spark, root, tables, files):
    """Write `tables` (name -> DataFrame) under `files` (name -> file name) and make them the newest set.

    Every run writes a folder of its own. The manifest is written under another name and renamed, which the file system
    does at once; of two runs that publish at the same time the second takes the next number.
    """
    folder = f"{VERSIONS}/{uuid.uuid4().hex}"
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{files[name]}"
        df.write.parquet(f"{root}/{paths[name]}")
    manifests, fs = _files(spark, f"{root}/{MANIFESTS}")
    fs.mkdirs(manifests)
    aside, _ = _files(spark, f"{root}/{MANIFESTS}/_{uuid.uuid4().hex}")
    out = fs.create(aside)
    out.write(json.dumps(paths).encode())
    out.close()
    number = max(_versions(spark, root), default=0) + 1
    while True:
        target, _ = _files(spark, f"{root}/{MANIFESTS}/{number:09d}.json")
        if not fs.exists(target) and fs.rename(aside, target):
            break
        if not fs.exists(target):
            raise RuntimeError(f"the manifest of {root} could not be published")
        number += 1
    return {name: f"{root}/{path}" for name, path in paths.items()}


def prune(spark, root, keep=2):
    """Delete all but the newest `keep` sets; for when no reader of an older one is left."""
    for number in _versions(spark, root)[: -keep or None]:
        manifest, fs = _files(spark, f"{root}/{MANIFESTS}/{number:09d}.json")
        lines = spark.read.text(f"{root}/{MANIFESTS}/{number:09d}.json").collect()
        folders = {path.rsplit("/", 1)[0] for path in json.loads("".join(r["value"] for r in lines)).values()}
        fs.delete(manifest, False)
        for folder in folders:
            fs.delete(_files(spark, f"{root}/{folder}")[0], True)
