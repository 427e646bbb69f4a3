"""Column expressions (cleaning, CVE extraction) and size-checked broadcast."""
