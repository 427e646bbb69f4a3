"""catalink: package-catalogue loading and CVE-fix evidence as Spark jobs."""

__version__ = "0.1.0"
