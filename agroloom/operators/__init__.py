"""DataFrame operators. All take the scope columns as ``by`` and return DataFrames."""
