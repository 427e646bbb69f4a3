"""User-facing jobs composed from operators: full load, incremental load, mapped load, CVE fix status, audits."""
