"""Population-genomics analytics as Spark DataFrame transformations.

Tables (see README): variants ``v``, long genotypes ``g``, intervals ``iv``, population
membership ``m``, reference chunks ``ref``, chromosome sizes ``sizes``, statistic tables ``st``.
Every operator takes and returns DataFrames and stays lazy unless its docstring says otherwise.
"""
