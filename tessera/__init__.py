"""Tessera: spatial-omics analytics and corpus preparation as Spark jobs."""
