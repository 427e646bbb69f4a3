"""DataFrame -> DataFrame operators: keys, crosswalk, natural keys, links, changelog, evidence, merge, audits."""
