"""One load at a time into a target, by a file that only one of them can create."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from daybook.plans.errors import BatchError


class Claim:
    """The claim on one target: a file that holds this load's mark.

    Creating it without overwriting is one step of the file system, so of several
    loads one gets it. (An object store without such a step offers no claim.)
    """

    def __init__(self, spark: SparkSession, root: str, target: str) -> None:
        hadoop = spark._jvm.org.apache.hadoop.fs
        self.target, self.mark = target, uuid.uuid4().hex
        self.path = hadoop.Path(f"{root.rstrip('/')}/{target}.claim")
        self.system = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def take(self) -> None:
        try:
            out = self.system.create(self.path, False)
        except Exception as error:
            if "AlreadyExists" in str(error) or "already exists" in str(error):
                raise BatchError(f"another load holds {self.target}, see {self.path.toString()}") from error
            raise
        try:
            out.writeUTF(self.mark)
        finally:
            out.close()

    def is_held(self) -> bool:
        if not self.system.exists(self.path):
            return False
        stream = self.system.open(self.path)
        try:
            return stream.readUTF() == self.mark
        finally:
            stream.close()

    def check(self) -> None:
        """Just before the target is written: somebody may have removed the claim as a dead load's."""
        if not self.is_held():
            raise BatchError(f"the claim on {self.target} was lost, see {self.path.toString()}")

    def release(self) -> None:
        if self.is_held():
            self.system.delete(self.path, False)


@contextmanager
def claimed(spark: SparkSession, root: str, target: str) -> Iterator[Claim]:
    """Hold the target for the time of the block; a claim left by a load that died has to be removed by hand."""
    claim = Claim(spark, root, target)
    claim.take()
    try:
        yield claim
    finally:
        claim.release()
