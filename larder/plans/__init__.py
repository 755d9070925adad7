from larder.plans.catalogue import Catalogue

__all__ = ["Catalogue"]
