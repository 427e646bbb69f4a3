"""Training-data pipeline operators (dedup, decontamination, packing, filters, ...).

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``registry`` maps them to the
registered queries ``opN_<name>``.
"""
