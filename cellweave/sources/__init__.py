"""Sources: workbooks, delimited files, tables, folder listings."""
