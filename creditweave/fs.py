"""Small files and folders on any of Spark's file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder that may not exist yet. Names are relative to it, with ``/`` between their parts."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark._jvm, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def has(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Names in the folder or one below it; none if there is no such folder."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name))) if self.has(name) else []

    def files(self, name: str = "") -> list[str]:
        """Full names of the data files in the folder or one below it; names that begin with ``_`` or ``.`` are none."""
        found = self._fs.listStatus(self._at(name)) if self.has(name) else []
        kept = [s for s in found if s.isFile() and s.getPath().getName()[0] not in "_."]
        return sorted(s.getPath().toString() for s in kept)

    def read(self, name: str) -> str | None:
        if not self.has(name):
            return None
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        self._put(name, text, overwrite=True)

    def claim(self, name: str, text: str) -> bool:
        """Writes the file whole unless there is one; tells whether it did.

        The text is written beside it first and renamed, which refuses a name that is taken: a reader sees all of it or nothing.
        """
        if self.has(name):
            return False
        beside = f"{name}.{self._jvm.java.util.UUID.randomUUID().toString()}.tmp"
        self._put(beside, text, overwrite=False)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self._fs.getConf())
        try:
            context.rename(self._at(beside), self._at(name), self._no_options())
        except Exception as error:
            self._fs.delete(self._at(beside), False)
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def _no_options(self):
        rename = self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        return self._jvm.java.lang.reflect.Array.newInstance(rename, 0)

    def _put(self, name: str, text: str, overwrite: bool) -> None:
        stream = self._fs.create(self._at(name), overwrite)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
