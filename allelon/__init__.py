"""Mutation analytics over large collections of genome assemblies, on Spark DataFrames."""
