"""Numbered entries beside a table: small JSON files, each number written once, whoever writes."""

from __future__ import annotations

import json
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Seconds after which an entry without content is that of a writer that died.
PATIENCE = 10.0


class NumberedLog:
    """The entries of a folder of any file system that Spark writes to.

    An entry is claimed by creating its file, which fails if it exists, so of two writers one gets a number. An entry
    whose writer died before its content was written is void.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self._folder = self._path(path)
        self._files = self._folder.getFileSystem(context._jsc.hadoopConfiguration())

    def _file(self, number: int):
        return self._path(self._folder, f"{number:012d}")

    def numbers(self) -> list[int]:
        try:
            names = [status.getPath().getName() for status in self._files.listStatus(self._folder)]
        except Py4JJavaError as error:
            if "FileNotFoundException" not in error.java_exception.getClass().getName():
                raise
            return []
        return sorted(int(name) for name in names if name.isdigit())

    def read(self, number: int) -> dict | None:
        """The entry of a number that ``numbers`` has; None if it is void."""
        while True:
            stream = self._files.open(self._file(number))
            try:
                text = bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
            if text.endswith("\n"):
                return json.loads(text)
            written = self._files.getFileStatus(self._file(number)).getModificationTime() / 1000
            if time.time() - written > PATIENCE:
                return None
            time.sleep(0.1)

    def last(self) -> tuple[int, dict]:
        """The last number that is taken and the last entry that is not void; (0, {}) without any."""
        numbers = self.numbers()
        entries = (self.read(n) for n in reversed(numbers))
        return (numbers[-1], next((e for e in entries if e is not None), {})) if numbers else (0, {})

    def add(self, number: int, entry: dict) -> bool:
        """Write an entry; False if the number is taken."""
        try:
            stream = self._files.create(self._file(number), False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False
        try:
            stream.write(bytearray((json.dumps(entry) + "\n").encode()))
        finally:
            stream.close()
        return True

    def append(self, entry: dict) -> int:
        """Write an entry under the next free number."""
        number = self.last()[0] + 1
        while not self.add(number, entry):
            number += 1
        return number

    def remove(self, number: int) -> None:
        self._files.delete(self._file(number), False)

    def remove_folder(self, path: str) -> None:
        """Remove a folder of the table that the log belongs to."""
        self._files.delete(self._path(path), True)
