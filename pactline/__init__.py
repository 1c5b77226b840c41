"""pactline: contract text analytics as Spark DataFrame jobs.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark SQL / DataFrame / MLlib primitives, so Catalyst plans the work and
``df.transform(f)`` composes it.
"""

from pactline.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
