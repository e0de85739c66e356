from gramspan.sources.dataset import Features, TabularDataset
from gramspan.sources.readers import from_rows, read_csv, read_table

__all__ = ["Features", "TabularDataset", "from_rows", "read_csv", "read_table"]
