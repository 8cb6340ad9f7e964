"""Operators over whole DataFrames. None of them triggers an action unless its docstring says so."""
