"""Bounded memory for per-word work inside tasks."""

from __future__ import annotations

import ctypes
import gc
import sys

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Memo(dict):
    """Remembers ``make(key)`` for short keys, in two generations of ``size`` entries each.

    A full young generation becomes the old one; entries found there move back up. Keys over
    ``longest`` characters are computed each time.
    """

    def __init__(self, make, size: int = 250_000, longest: int = 200):
        super().__init__()
        self.make, self.size, self.longest, self.old = make, size, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def forget() -> None:
    """Drops what this worker keeps; tasks of other operators call it before they fill memory."""
    vars(sys).pop("_kept_by_worker", None)


def trim() -> None:
    """Hands memory that is free back to the system: large arrays that are gone leave gaps, which
    the C library keeps for the life of the process."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(spark) -> None:
    """Hands the driver's free memory back, Python's and the JVM's. With the objects that are gone
    Spark drops their broadcasts and shuffle files."""
    trim()
    spark.sparkContext._jvm.System.gc()
    trim_jvm(spark)


def trim_jvm(spark) -> bool:
    """What ``trim`` does, for the driver's JVM: its hundreds of threads leave gaps in the C library's
    memory that no collection of garbage gives back. False where the JVM has no such command."""
    context = spark.sparkContext
    java, gateway = context._jvm, context._gateway
    kind = java.java.lang.Class.forName
    # The server's own class is closed to callers; its interface is not.
    types = gateway.new_array(java.java.lang.Class, 4)
    given = gateway.new_array(java.java.lang.Object, 4)
    types[0], types[1] = kind("javax.management.ObjectName"), kind("java.lang.String")
    types[2], types[3] = kind("[Ljava.lang.Object;"), kind("[Ljava.lang.String;")
    given[0] = java.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    given[1] = "systemTrimNativeHeap"
    server = java.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    try:
        kind("javax.management.MBeanServer").getMethod("invoke", types).invoke(server, given)
    except Py4JJavaError:  # another JVM, or another system
        return False
    return True


def holds(key: tuple) -> bool:
    """Whether this worker has the object that ``kept`` gives for the key."""
    return key in vars(sys).get("_kept_by_worker", {})


def kept(key: tuple, make):
    """What ``make()`` gave for the key, for as long as this Python worker lives.

    Workers serve many tasks, and each task receives its functions anew, so the object is held
    by the interpreter and not by a module. Only the latest is held, until ``forget``.
    """
    held = vars(sys).setdefault("_kept_by_worker", {})
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]
