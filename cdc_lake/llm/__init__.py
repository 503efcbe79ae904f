"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Common rules, unless an
operator's docstring says otherwise: a null text counts as empty, rows with a
null id are kept and carry the null through, repeated rows are separate rows,
an empty table gives an empty result with the same columns, and extra input
columns are ignored (whatever their names).  Intermediate tables are written
to the shared folder named by ``spark.checkpoint.dir`` (:mod:`.common`), so a
lost executor costs at most the tasks since the last written table.
"""
