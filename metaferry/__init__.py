"""metaferry: Spark jobs that carry data-catalog metadata from a source to a target environment.

Every public function takes and returns lazy DataFrames (or Columns). Nothing
here runs a Spark action unless its docstring says so.
"""
