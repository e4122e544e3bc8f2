"""opsloom: operations analytics written as Spark DataFrame plans."""
